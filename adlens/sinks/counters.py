"""Exactly-once counters (K-2): deltas fenced by their epoch, folded later.

A batch's deltas are stored under its (query, batch) and nowhere else, so a replayed batch
rewrites its own deltas instead of adding them again. A counter's value is its folded base
plus the deltas after the fence. ``fold`` adds deltas up into a new base and moves the fence,
with one marker file as its commit; a replay of a folded batch is recognised by the fence
and skipped.

A key-value store gets values, not increments (:meth:`EpochCounters.publish`): setting a value
twice is setting it once.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import read_or_none
from adlens.sources import files

DELTAS = "query string, batch_id long, key string, value long"


class EpochCounters:
    """Counters under ``path``. Keys are texts (a null key is a counter of its own); batches of
    one query arrive in ascending order, replays excepted."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _folds(self) -> dict:
        """The newest fold: {base: folder, fence: {query: last batch folded}}."""
        found = files.names(f"{self.path}/_folds")
        return json.loads(files.read(f"{self.path}/_folds/{found[-1]}")) if found else {"base": None, "fence": {}}

    def apply(self, deltas: DataFrame, query: str, batch_id: int) -> bool:
        """Add ``deltas`` (key, value) as epoch (query, batch_id). False if it was folded before."""
        if batch_id <= self._folds()["fence"].get(query, -1):
            return False
        sums = deltas.groupBy("key").agg(F.sum("value").cast("long").alias("value"))
        sums.write.mode("overwrite").parquet(os.path.join(self.path, "deltas", f"query={query}", f"batch_id={batch_id}"))
        return True

    def _open(self, spark: SparkSession, fold: dict) -> DataFrame:
        """Deltas after the fence: folders the fence covers are not read (partition pruning)."""
        rows = read_or_none(spark, os.path.join(self.path, "deltas"), DELTAS)
        if rows is None:
            return spark.createDataFrame([], DELTAS)
        for query, upto in fold["fence"].items():  # one condition per query
            rows = rows.filter(~((F.col("query") == query) & (F.col("batch_id") <= upto)))
        return rows

    def values(self, spark: SparkSession, fold: dict | None = None) -> DataFrame:
        """(key, value) of every counter."""
        fold = fold or self._folds()
        rows = self._open(spark, fold).select("key", "value")
        if fold["base"]:
            rows = rows.unionByName(spark.read.schema("key string, value long").parquet(os.path.join(self.path, fold["base"])))
        return rows.groupBy("key").agg(F.sum("value").cast("long").alias("value"))

    def fold(self, spark: SparkSession) -> dict[str, int]:
        """Fold the open deltas into a new base; returns the fence. A fold that dies before its
        marker leaves the old one in force."""
        old = self._folds()
        upto = {r["query"]: r["upto"] for r in self._open(spark, old).groupBy("query").agg(F.max("batch_id").alias("upto")).collect()}
        if not upto:
            return old["fence"]
        base = f"base-{uuid.uuid4().hex[:12]}"
        self.values(spark, old).write.parquet(os.path.join(self.path, base))
        new = {"base": base, "fence": {**old["fence"], **upto}}
        n = len(files.names(f"{self.path}/_folds"))
        files.put(f"{self.path}/_folds/{n:08d}.json", lambda out: out.write(json.dumps(new).encode()))
        return new["fence"]

    def publish(self, spark: SparkSession, keys: DataFrame, connect: Callable[[], object]) -> None:
        """Set the current value of ``keys`` (key) in a KV store, one client per partition
        (``set`` and ``close``)."""
        rows = self.values(spark).join(keys.select("key").distinct(), "key", "left_semi")

        def run(part):
            client = connect()
            try:
                for r in part:
                    client.set(r["key"], int(r["value"]))
            finally:
                client.close()

        rows.foreachPartition(run)


class EpochCounterSink:
    """foreachBatch body: ``count(batch)`` gives the batch's (key, value), applied once whatever
    is replayed, folded every ``fold_every`` batches, and published if ``connect`` is given."""

    def __init__(self, counters: EpochCounters, count: Callable[[DataFrame], DataFrame], fold_every: int = 1000,
                 connect: Callable[[], object] | None = None):
        self.counters, self.count, self.fold_every, self.connect = counters, count, fold_every, connect
        self.open = 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        deltas = self.count(batch)
        if self.counters.apply(deltas, query, batch_id):
            self.open += 1
            if self.connect is not None:
                stored = os.path.join(self.counters.path, "deltas", f"query={query}", f"batch_id={batch_id}")
                self.counters.publish(spark, spark.read.schema("key string, value long").parquet(stored), self.connect)
        if self.open >= self.fold_every:
            self.counters.fold(spark)
            self.open = 0
