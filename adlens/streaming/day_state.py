"""Day totals with a state of their own (ST-3 b): seeded, bounded, expiring.

``groupBy().count()`` cannot start from stored totals and knows no end of a day. Here a
``transformWithState`` operator keeps the totals of a day's deals, dealt over ``buckets`` by a hash
of the deal: a state row per (day, bucket), so a micro-batch costs a few state calls per
bucket, not per deal.

* a bucket starts from the stored totals (``initialState``), which the reference reads anew
  from its table in every batch;
* a timer at the day's end plus the watermark's delay clears it, so the state holds the days
  that may still get records and nothing else; records of closed days are dropped by the
  watermark, as in any event-time aggregate;
* every micro-batch emits the new totals of the deals it touched.

Records are counted chunk by chunk, so a hot deal is a number in its task. Choose ``buckets`` so
that a bucket's deals of one day are some thousand. Topic filter and parsing stay column expressions before the operator, and only key and time
travel to it.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from adlens.operators import counters
from adlens.session import scratch_path
from adlens.streaming.deal_stream import BatchLedgerSink

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOTALS = "has_deal boolean, deal string, now_time string, total long"
KEY = ["now_time", "bucket"]


def day_end_ms(day: str) -> int:
    """The end of a ``yyyy-MM-dd`` day, in ms."""
    end = dt.datetime.strptime(day, "%Y-%m-%d").replace(tzinfo=dt.timezone.utc) + dt.timedelta(days=1)
    return int(end.timestamp() * 1000)


class DayTotals(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "deals array<string>, totals array<bigint>")  # a null deal stays null

    def _held(self) -> dict[str | None, int]:
        return dict(zip(*self.totals.get())) if self.totals.exists() else {}

    def _keep(self, key, held: dict[str | None, int], timerValues, new: bool) -> None:
        self.totals.update((list(held), list(held.values())))
        # Records without a time have no day that could end. The watermark is behind by its
        # delay, so the timer fires that much after the day's end.
        if new and isinstance(key[0], str):
            self.handle.registerTimer(max(day_end_ms(key[0]), timerValues.getCurrentWatermarkInMs() + 1))

    @staticmethod
    def _deals(chunk: pd.DataFrame) -> list[str | None]:
        return [d if has else None for has, d in zip(chunk["has_deal"].tolist(), chunk["deal"].tolist())]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        held = self._held()
        new = not held
        for deal, n in zip(self._deals(initialState), initialState["stored"].tolist()):
            held[deal] = held.get(deal, 0) + int(n)
        self._keep(key, held, timerValues, new)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for chunk in rows:
            counts.update(self._deals(chunk))
        if not counts:
            return
        held = self._held()
        new = not held
        for deal, n in counts.items():
            held[deal] = held.get(deal, 0) + n
        self._keep(key, held, timerValues, new)
        deals = list(counts)
        yield pd.DataFrame({"has_deal": [d is not None for d in deals], "deal": [d or "" for d in deals], "now_time": [key[0]] * len(deals),
                            "total": [held[d] for d in deals]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.totals.clear()
        return iter(())

    def close(self) -> None:
        pass


def _keyed(df: DataFrame, buckets: int, *more) -> DataFrame:
    """The deal, a missing one told from any text, and its bucket."""
    return df.select(F.col("dealid").isNotNull().alias("has_deal"), F.coalesce("dealid", F.lit("")).alias("deal"),
                     F.pmod(F.xxhash64("dealid"), F.lit(buckets)).cast("int").alias("bucket"), *more)


def seeded_day_totals(raw: DataFrame, stored: DataFrame, delay: str, buckets: int = 64) -> DataFrame:
    """Streaming (dealid, now_time, total) of the records ``raw`` (ts, value) that name the topic: per
    micro-batch the new total of every (deal, event day) it touched, starting from ``stored``
    (dealid, now_time, total). Days in UTC; ``delay`` is the watermark's."""
    recs = counters.with_dealid(counters.keep_topic(raw)).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    rows = _keyed(recs, buckets, F.to_date("ts").cast("string").alias("now_time"), "ts")
    seed = _keyed(stored.filter("now_time IS NOT NULL"), buckets, "now_time", F.col("total").cast("long").alias("stored"))
    out = rows.groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=DayTotals(), outputStructType=TOTALS, outputMode="Update", timeMode="EventTime",
        initialState=seed.groupBy(*KEY))
    return out.select(F.when(F.col("has_deal"), F.col("deal")).alias("dealid"), "now_time", "total")


def run_seeded_totals(spark: SparkSession, raw: DataFrame, stored: DataFrame, out_path: str | None = None, checkpoint: str | None = None,
                      trigger: dict | None = None, delay: str = "2 days", compact_every: int | None = 1000, buckets: int = 64):
    """Start the counter with the batch sink of the other totals; returns (query, out_path).
    ``latest_totals`` reads the result: one query's totals, seeds included, so a query on a
    new checkpoint needs a new ``out_path``."""
    out_path = out_path or scratch_path(spark, "seeded_totals")
    checkpoint = checkpoint or scratch_path(spark, "seeded_totals_ckpt")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)  # read when a query starts
    try:
        q = (seeded_day_totals(raw, stored, delay, buckets).writeStream.outputMode("update")
             .foreachBatch(BatchLedgerSink(out_path, compact_every)).option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"availableNow": True})).start())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return q, out_path
