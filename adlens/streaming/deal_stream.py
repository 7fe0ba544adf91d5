"""Streaming exposure counter (R-8, ST-1 ... ST-8) and the parse stream (R-9).

Default (ST-3 b): per-(deal, day) counts kept in Spark's state store, emitted
in ``update`` mode. The ``foreachBatch`` sink writes each micro-batch's updated
rows to ``<path>/query=Q/batch_id=N`` with overwrite, so a replayed batch rewrites its
own folder instead of adding twice. A query's total of a key is its row in the query's
highest batch; a query on a new checkpoint counts anew from zero under its own id, so
the current total is the sum over queries. Checkpoints live under the shared checkpoint folder.

Variant (ST-3 a): read-add-write against an outside totals table, as the
reference does, made replay-safe by a ledger of applied (query, batch) ids.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators import counters
from adlens.schemas import STREAM_RECORD
from adlens.session import read_or_none, scratch_path
from adlens.functions.scalar import counter_key
from adlens.sinks import merge, writers
from adlens.sinks.counters import EpochCounters
from adlens.fixed import BATCH_INTERVAL, CAP_SLACK


def day_column(mode: str = "event", ts_col: str = "ts"):
    """ST-8: event date, or the processing date of the micro-batch (the reference)."""
    if mode == "event":
        return F.to_date(F.col(ts_col).cast("timestamp")).cast("string")
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd")


def parsed_deals(raw: DataFrame, keep=("event_id",)) -> DataFrame:
    """R-9: ``from_json`` into the 17-field record, then ``data.dealid`` (malformed -> null)."""
    data = F.from_json(F.col("value").cast("string"), STREAM_RECORD)
    return raw.select(*keep, data.getField("dealid").alias("dealid"))


def deal_day_counts(raw: DataFrame, day_mode: str = "event", watermark: str | None = None) -> DataFrame:
    """Topic filter + count per (deal, day).

    ``processing``: the day of the micro-batch (the reference). Days are 1-day windows
    over the batch time with a watermark on it, so a day's state is dropped once the
    day is over. ``event``: the event's day; exact for any lateness (state kept) unless
    ``watermark`` is given, then days older than the watermark are closed and dropped.
    """
    recs = counters.keep_topic(raw)
    if day_mode == "processing":
        t, delay = F.current_timestamp(), watermark or "0 seconds"
    elif watermark:
        t, delay = F.col("ts").cast("timestamp"), watermark
    else:
        return counters.day_counts(recs, day_column(day_mode))
    # Windows align to UTC midnight; shifting the time to the session's wall clock
    # makes them the session's local days (DST included).
    tz = raw.sparkSession.conf.get("spark.sql.session.timeZone")
    timed = recs.withColumn("_t", F.from_utc_timestamp(t, tz)).withWatermark("_t", delay)
    day = F.date_format(F.to_utc_timestamp(F.col("_w.start"), tz), "yyyy-MM-dd")
    return (counters.with_dealid(timed).groupBy("dealid", F.window("_t", "1 day").alias("_w"))
            .agg(F.count(F.lit(1)).alias("total"))
            .select("dealid", day.alias("now_time"), "total"))


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query a micro-batch belongs to. It lives in the checkpoint, so a
    restart keeps it and a new checkpoint gets a new one; ``direct`` outside a query."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


class BatchLedgerSink:
    """foreachBatch body writing each batch's rows to ``<path>/query=Q/batch_id=N`` (idempotent).

    With ``compact_every`` the totals are snapshot once that many batches, empty ones
    included, have passed since the last snapshot and something was written meanwhile."""

    def __init__(self, path: str, compact_every: int | None = None):
        self.path, self.compact_every = path, compact_every
        self.snapped: int | None = None  # this query's last batch before the newest snapshot
        self.fresh = True  # something was written since (unknown after a restart: assumed)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        own = query_id(batch)
        batch = batch.persist()  # two actions below; the stateful batch is computed once
        try:
            if not batch.isEmpty():  # ST-2: nothing to write for an empty batch
                batch.write.mode("overwrite").parquet(os.path.join(self.path, f"query={own}", f"batch_id={batch_id}"))
                self.fresh = True
        finally:
            batch.unpersist()
        if self.compact_every:
            self._compact(batch.sparkSession, own, batch_id)

    def _compact(self, spark: SparkSession, own: str, batch_id: int) -> None:
        if self.snapped is None:
            snaps = read_or_none(spark, os.path.join(self.path, SNAPSHOTS))
            upto = None if snaps is None else snaps.filter(F.col("query") == own).agg(F.max("upto")).first()[0]
            self.snapped = -1 if upto is None else upto
        if self.fresh and batch_id - self.snapped >= self.compact_every:
            compact_totals(spark, self.path)
            self.snapped, self.fresh = batch_id, False


SNAPSHOTS = "_snapshot"  # underscore: not a partition of the batch folders


def _per_query(spark: SparkSession, path: str, keys) -> DataFrame | None:
    """(query, *keys, total, upto) after all batches. Reads the newest snapshot, if any, and
    only the batch folders after it (partition pruning)."""
    rows = read_or_none(spark, path)
    if rows is None:
        return None
    rows = rows.select(F.col("query").cast("string").alias("query"), F.col("batch_id").cast("long").alias("batch_id"),
                       *keys, F.col("total").cast("bigint").alias("total"))
    snaps = read_or_none(spark, os.path.join(path, SNAPSHOTS))
    if snaps is not None:
        snap = snaps.filter(F.col("snap") == snaps.agg(F.max("snap")).first()[0])
        covered = F.lit(False)
        for r in snap.groupBy("query").agg(F.max("upto").alias("upto")).collect():  # one row per query
            covered = covered | ((F.col("query") == r["query"]) & (F.col("batch_id") <= r["upto"]))
        rows = rows.filter(~covered).unionByName(snap.select("query", F.col("upto").alias("batch_id"), *keys, "total"))
    return rows.groupBy("query", *keys).agg(F.max_by("total", "batch_id").alias("total"), F.max("batch_id").alias("upto"))


def latest_totals(spark: SparkSession, path: str, keys=("dealid", "now_time")) -> DataFrame:
    """Current value per key: each query's row of the highest batch, summed over queries."""
    rows = _per_query(spark, path, keys)
    if rows is None:
        raise FileNotFoundError(f"no batch was written to {path}")
    return rows.groupBy(*keys).agg(F.sum("total").cast("bigint").alias("total"))


def compact_totals(spark: SparkSession, path: str, keys=("dealid", "now_time")) -> int | None:
    """Write the current totals per query as a snapshot; later reads skip the batch folders
    it covers. Returns the highest batch id covered (None if no batch)."""
    rows = _per_query(spark, path, keys)
    if rows is None:
        return None
    # A query's snapshot covers all its batches, whichever key a batch touched.
    last = rows.groupBy("query").agg(F.max("upto").alias("last"))
    rows = rows.join(last, "query").select("query", *keys, "total", F.col("last").alias("upto"))
    snaps = read_or_none(spark, os.path.join(path, SNAPSHOTS))
    n = 0 if snaps is None else snaps.agg(F.max("snap")).first()[0] + 1
    rows.write.mode("overwrite").parquet(os.path.join(path, SNAPSHOTS, f"snap={n}"))
    return spark.read.parquet(os.path.join(path, SNAPSHOTS, f"snap={n}")).agg(F.max("upto")).first()[0]


def run_deal_totals(spark: SparkSession, raw_stream: DataFrame, out_path: str | None = None,
                    checkpoint: str | None = None, trigger: dict | None = None,
                    day_mode: str = "event", watermark: str | None = None, compact_every: int | None = 1000):
    """Start the counter; returns (query, out_path). ``trigger`` defaults to availableNow."""
    out_path = out_path or scratch_path(spark, "deal_totals")
    checkpoint = checkpoint or scratch_path(spark, "deal_totals_ckpt")
    q = (deal_day_counts(raw_stream, day_mode, watermark).writeStream
         .outputMode("update").foreachBatch(BatchLedgerSink(out_path, compact_every))
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    return q, out_path


def run_parse_stream(spark: SparkSession, raw_stream: DataFrame, out_path: str | None = None,
                     checkpoint: str | None = None, trigger: dict | None = None):
    """R-9 with an exactly-once parquet file sink (append); console is ``fmt='console'``."""
    out_path = out_path or scratch_path(spark, "parsed_deals")
    checkpoint = checkpoint or scratch_path(spark, "parsed_deals_ckpt")
    q = (parsed_deals(raw_stream).writeStream.outputMode("append").format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    return q, out_path


def console(df: DataFrame, checkpoint: str, trigger: dict | None = None):
    """K-5: the reference's console sink."""
    return (df.writeStream.outputMode("append").format("console")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": BATCH_INTERVAL})).start())


class ReadAddWriteSink:
    """ST-3 a / ST-4 inside foreachBatch: add batch counts to an outside totals table,
    write its new version, flag deals near their cap.

    State is a directory of versions ``v=N`` plus a ledger of applied (query, batch,
    version) rows (parquet, appended after the version is written). A query's batches
    arrive in order, so a batch id not above the query's largest is a replay and is
    skipped (D13); a query on a new checkpoint has an id of its own, so its batches are
    not mistaken for replays. A batch that died before its ledger row is recomputed from
    the previous version and overwrites its own files. The batch's counts and totals are
    persisted while everything is written from them (K-6), then released.

    Counts without a deal cannot be stored under a key: they are reported in
    ``<state>/_null_deals`` (D15). With ``store_caps`` the cap table is versioned beside
    the totals and every flagged row gets ``stop = 1`` (K-3).
    """

    LEDGER = "query string, batch_id long, version long"

    def __init__(self, state_path: str, caps: DataFrame | None = None, flags_path: str | None = None,
                 slack: int = CAP_SLACK, day=None, initial: DataFrame | None = None, kv_connect=None,
                 store_caps: bool = False, counters: EpochCounters | None = None):
        """``day``: a ``yyyy-MM-dd`` text, a Column (e.g. the event date), or None for the
        processing date. ``initial``: the totals table before the first batch.
        ``kv_connect``: optional KV client factory; each batch's per-deal counts are then
        added to ``<prefix><dealid>`` counters (K-2). Those increments are at-least-once,
        as in the reference: a batch that dies before its ledger row adds them again. With
        ``counters`` the batch's counts are an epoch there, applied once, and ``kv_connect``'s
        store is set to the counters' values."""
        self.state_path, self.caps, self.flags_path = state_path, caps, flags_path
        self.slack, self.day, self.initial, self.kv_connect = slack, day, initial, kv_connect
        self.store_caps, self.counters = store_caps, counters
        self.ledger_path = os.path.join(state_path, "_ledger")

    def _ledger(self, spark: SparkSession) -> DataFrame | None:
        return read_or_none(spark, self.ledger_path, self.LEDGER)

    def last_applied(self, spark: SparkSession) -> int | None:
        """The newest committed version (None before the first)."""
        ledger = self._ledger(spark)
        return None if ledger is None else ledger.agg(F.max("version")).first()[0]

    def current(self, spark: SparkSession) -> DataFrame | None:
        last = self.last_applied(spark)
        return None if last is None else spark.read.parquet(os.path.join(self.state_path, f"v={last}"))

    def current_caps(self, spark: SparkSession) -> DataFrame | None:
        """The cap table with the stop flags set so far."""
        last = self.last_applied(spark) if self.store_caps else None
        return self.caps if last is None else spark.read.parquet(os.path.join(self.state_path, "_caps", f"v={last}"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, query_id(batch)
        ledger = self._ledger(spark)
        last = None
        if ledger is not None:
            last, seen = ledger.agg(F.max("version"), F.max(F.when(F.col("query") == own, F.col("batch_id")))).first()
            if seen is not None and batch_id <= seen:
                return
        day = self.day if self.day is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd")
        every = counters.day_counts(counters.keep_topic(batch), day).persist()
        running = None
        try:
            if every.isEmpty():
                return
            version = 0 if last is None else last + 1
            self._report_null_deals(every.filter(F.col("dealid").isNull()), own, batch_id)
            stored = self.current(spark)
            if stored is None:
                stored = (self.initial if self.initial is not None
                          else spark.createDataFrame([], "dealid string, now_time string, total bigint"))
            stored = stored.select("dealid", "now_time", F.col("total").cast("bigint").alias("total"))
            running = counters.add_to_totals(every.filter(F.col("dealid").isNotNull()), stored).persist()
            if self.kv_connect is not None or self.counters is not None:
                per_deal = every.groupBy(counter_key("dealid").alias("key")).agg(F.sum("total").alias("value"))
                if self.counters is None:
                    writers.add_counters(per_deal, self.kv_connect)
                else:
                    self.counters.apply(per_deal, own, batch_id)
                    if self.kv_connect is not None:
                        self.counters.publish(spark, per_deal, self.kv_connect)
            if self.caps is not None and self.flags_path:
                caps = self.current_caps(spark)
                flagged = counters.near_cap(running, caps, self.slack)
                flagged.write.mode("overwrite").parquet(os.path.join(self.flags_path, f"query={own}", f"batch_id={batch_id}"))
                if self.store_caps:
                    (counters.apply_stop_flags(caps, flagged)
                     .write.mode("overwrite").parquet(os.path.join(self.state_path, "_caps", f"v={version}")))
            new_state = merge.upsert(stored, running, ["dealid", "now_time"], ["total"], check_unique=False)
            new_state.write.mode("overwrite").parquet(os.path.join(self.state_path, f"v={version}"))
            # The ledger row commits the batch.
            spark.createDataFrame([(own, batch_id, version)], self.LEDGER).coalesce(1).write.mode("append").parquet(self.ledger_path)
        finally:
            every.unpersist()
            if running is not None:
                running.unpersist()

    def _report_null_deals(self, counts: DataFrame, own: str, batch_id: int) -> None:
        counts.write.mode("overwrite").parquet(os.path.join(self.state_path, "_null_deals", f"query={own}", f"batch_id={batch_id}"))


def run_read_add_write(spark: SparkSession, raw_stream: DataFrame, sink: ReadAddWriteSink,
                       checkpoint: str | None = None, trigger: dict | None = None):
    """ST-1 + ST-3 a: the reference's micro-batch loop (default trigger: every 10 s)."""
    checkpoint = checkpoint or scratch_path(spark, "read_add_write_ckpt")
    return (raw_stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": BATCH_INTERVAL})).start())


def stop_gracefully(query, timeout_s: float = 60.0) -> None:
    """ST-7: let the running micro-batch finish, then stop."""
    import time
    deadline = time.time() + timeout_s
    while query.isActive and query.status.get("isTriggerActive") and time.time() < deadline:
        time.sleep(0.2)
    query.stop()
