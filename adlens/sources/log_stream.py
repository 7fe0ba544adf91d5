"""A partitioned log with offsets of its own as a stream source (SRC-5, SRC-6).

The reference reads a topic whose records are dealt over partitions by key and numbered in
each; its consumer group's offsets are committed after each batch. ``format("adlens_log")``
reads such a log from a shared folder, with the columns of a topic: topic, partition,
offset, timestamp, key, value.

* A micro-batch takes at most about ``max_records`` records, shared over the partitions by
  their backlog (``latestOffset``), and one task reads one segment's part of it.
* Offsets live in the query's checkpoint, so a restart repeats and loses nothing. The group
  file holds two more marks: ``committed``, from where a query on a new checkpoint goes on
  (as a consumer group does), and ``planned``, the last end handed to Spark, which keeps
  the ends from running backwards when a restarted reader has forgotten them.
* :func:`append_log` numbers records by a range sort, so a hot key's partition is written by
  many tasks, in segments of bounded size. An append becomes visible as a whole, with its
  marker file; a failed one leaves segments that no reader counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from adlens.fixed import LOG_TOPIC
from adlens.operators.ordering import rank_within
from adlens.sources import files

FORMAT = "adlens_log"
SCHEMA = "topic string, partition int, offset long, timestamp timestamp, key string, value string"
SEGMENT_ROWS = 1 << 18


# ------------------------------------------------------------------ the log's folder

def _appends(path: str) -> list[dict]:
    """Markers of finished appends, oldest first: {append, topic, ends: [per partition]}."""
    return [json.loads(files.read(f"{path}/_appends/{n}")) for n in files.names(f"{path}/_appends")]


def end_offsets(path: str) -> list[int]:
    """The offset after the last record of every partition."""
    return _last(_appends(path))["ends"]


def _last(appends: list[dict]) -> dict:
    if not appends:
        raise FileNotFoundError("nothing was appended to the log")
    return appends[-1]


def segments(path: str, partition: int) -> list[tuple[int, int, str]]:
    """(first offset, records, file) of a partition's visible segments, in offset order."""
    visible = {a["append"] for a in _appends(path)}
    out = []
    for name in files.names(f"{path}/p={partition}"):
        first, n, append = name.removesuffix(".parquet").split("-")
        if append in visible:
            out.append((int(first), int(n), f"{path}/p={partition}/{name}"))
    return sorted(out)


def append_log(records: DataFrame, path: str, order: list[str | Column], partitions: int = 4, topic: str = LOG_TOPIC,
               segment_rows: int = SEGMENT_ROWS) -> list[int]:
    """Append ``records`` (key, value, timestamp) and return the partitions' new ends.

    Records of one key go to one partition, in ``order``; records without a key are dealt by
    their value. The number of partitions is fixed by the first append.
    """
    path = path.rstrip("/")
    before = _appends(path)
    starts = _last(before)["ends"] if before else [0] * partitions
    append = uuid.uuid4().hex
    dealt = records.select("key", "value", F.col("timestamp").cast("timestamp").alias("timestamp"), *_order_columns(order),
                           F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(len(starts))).cast("int").alias("partition"))
    at = rank_within(dealt, ["partition"], [f"_o{i}" for i in range(len(order))], out="_rn", hot=True)
    start = F.get(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("partition"))
    at = at.select("partition", (start + F.col("_rn") - 1).alias("offset"), "timestamp", "key", "value")
    at = at.withColumn("segment", F.expr(f"`offset` div {segment_rows}L"))

    def write(group: pd.DataFrame) -> pd.DataFrame:
        import pyarrow as pa
        import pyarrow.parquet as pq
        group = group.sort_values("offset")
        first, n, p = int(group["offset"].iloc[0]), len(group), int(group["partition"].iloc[0])
        stamps = pa.Array.from_pandas(group["timestamp"], type=pa.timestamp("us", "UTC"))
        table = pa.table({"topic": pa.array([topic] * n, pa.string()), "partition": pa.array([p] * n, pa.int32()),
                          "offset": pa.Array.from_pandas(group["offset"], type=pa.int64()), "timestamp": stamps,
                          "key": pa.Array.from_pandas(group["key"], type=pa.string()),
                          "value": pa.Array.from_pandas(group["value"], type=pa.string())})
        # A repeated task writes the same records under the same name.
        files.put(f"{path}/p={p}/{first:020d}-{n}-{append}.parquet", lambda out: pq.write_table(table, out))
        return pd.DataFrame({"partition": [p], "n": [n]})

    spread = at.repartition(int(at.sparkSession.conf.get("spark.sql.shuffle.partitions")), "partition", "segment")
    written = spread.groupBy("partition", "segment").applyInPandas(write, "partition int, n long")
    ends = list(starts)
    for r in written.groupBy("partition").agg(F.sum("n").alias("n")).collect():  # one row per log partition
        ends[r["partition"]] += r["n"]
    marker = {"append": append, "topic": topic, "ends": ends}
    files.put(f"{path}/_appends/{len(before):08d}-{append}.json", lambda out: out.write(json.dumps(marker).encode()))
    return ends


def _order_columns(order: list[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)]


# ------------------------------------------------------------------ reading

class Slice(InputPartition):
    """One task's part: (file, first record, records)."""


def _slices(path: str, start: list[int], end: list[int]) -> list[InputPartition]:
    out = []
    for p, (a, b) in enumerate(zip(start, end)):
        if a >= b:
            continue
        for first, n, name in segments(path, p):
            lo, hi = max(a, first), min(b, first + n)
            if lo < hi:
                out.append(Slice((name, lo - first, hi - lo)))
    return out


def _records(part: InputPartition) -> Iterator:
    import pyarrow.parquet as pq
    if part.value is None:
        return
    name, skip, n = part.value
    fs, leaf = files.filesystem(name)
    with fs.open_input_file(leaf) as f:
        for batch in pq.ParquetFile(f).iter_batches(batch_size=1 << 14):
            if n <= 0:
                return
            if skip >= batch.num_rows:
                skip -= batch.num_rows
                continue
            taken = batch.slice(skip, n)
            skip, n = 0, n - taken.num_rows
            yield taken


class LogReader(DataSourceReader):
    """The whole log as a batch."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> Sequence[InputPartition]:
        ends = end_offsets(self.path)
        return _slices(self.path, [0] * len(ends), ends) or [Slice(None)]

    def read(self, partition: InputPartition) -> Iterator:
        return _records(partition)


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, group: str | None, max_records: int | None):
        if max_records is not None and not group:
            raise ValueError("max_records needs a group: the reader must remember its last end")
        self.path, self.group, self.max_records = path, group, max_records
        self.at: list[int] | None = None

    def _marks(self) -> dict:
        if self.group and f"{self.group}.json" in files.names(f"{self.path}/_groups"):
            return json.loads(files.read(f"{self.path}/_groups/{self.group}.json"))
        return {}

    def _mark(self, **marks) -> None:
        if self.group:
            text = json.dumps({**self._marks(), **marks}).encode()
            files.put(f"{self.path}/_groups/{self.group}.json", lambda out: out.write(text))

    @staticmethod
    def _dict(offsets: list[int]) -> dict:
        return {str(p): o for p, o in enumerate(offsets)}

    @staticmethod
    def _list(offsets: dict) -> list[int]:
        return [offsets[str(p)] for p in range(len(offsets))]

    def initialOffset(self) -> dict:
        return self._dict(self._marks().get("committed") or [0] * len(end_offsets(self.path)))

    def latestOffset(self) -> dict:
        ends = end_offsets(self.path)
        if self.max_records is None:
            return self._dict(ends)
        if self.at is None:
            marks = self._marks()
            self.at = marks.get("planned") or marks.get("committed") or [0] * len(ends)
        backlog = [e - a for e, a in zip(ends, self.at)]
        total = sum(backlog)
        if total:
            self.at = [a + min(b, -(-self.max_records * b // total)) for a, b in zip(self.at, backlog)]
            self._mark(planned=self.at)
        return self._dict(self.at)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self.max_records is not None:  # a replayed batch may end beyond what this reader has planned
            self.at = [max(a, b) for a, b in zip(self.at or self._list(end), self._list(end))]
        return _slices(self.path, self._list(start), self._list(end))

    def read(self, partition: InputPartition) -> Iterator:
        return _records(partition)

    def commit(self, end: dict) -> None:
        self._mark(committed=self._list(end))


class LogSource(DataSource):
    """Options: ``path``; for streams ``group`` (whose offsets are committed) and ``max_records``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return LogReader(self.options["path"].rstrip("/"))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        most = self.options.get("max_records")
        return LogStreamReader(self.options["path"].rstrip("/"), self.options.get("group"), int(most) if most else None)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LogSource)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the log, as a batch."""
    register(spark)
    return spark.read.format(FORMAT).load(path)


def stream_log(spark: SparkSession, path: str, group: str | None = None, max_records: int | None = None) -> DataFrame:
    """The log as a stream."""
    register(spark)
    reader = spark.readStream.format(FORMAT)
    for name, value in (("group", group), ("max_records", max_records)):
        if value is not None:
            reader = reader.option(name, str(value))
    return reader.load(path)


def drain(query) -> None:
    """Run a query until it has read all that was there, then stop it. (``availableNow`` would
    take a source without admission control in one batch.)"""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
