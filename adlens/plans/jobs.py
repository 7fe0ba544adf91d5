"""End-to-end jobs as the reference runs them (R-7, R-8, R-11), minus its hosts and secrets.

Inputs and outputs are paths / formats / factories given by the caller; each
function builds DataFrames from the operators and writes them with one action.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens import schemas
from adlens.operators import reports, segments
from adlens.operators.ordering import checkpointed
from adlens.plans.incremental import IncrementalExposure
from adlens.sinks import dbapi, merge, writers
from adlens.sinks.counters import EpochCounters
from adlens.session import scratch_path
from adlens.sources import logs
from adlens.streaming import deal_stream
from adlens.fixed import BATCH_INTERVAL

REPORT_KEYS = {"bg": (["dealid", "daytime"], ["total"]),
               "success": (["dealid", "daytime"], ["total"]),
               "fail": (["dsp_id", "daytime"], ["return", "timeout", "else_error", "total"])}


def build_reports(spark: SparkSession, exposure_root: str, request_root: str, ssp_tag: DataFrame,
                  orders: DataFrame, run: reports.RunDay | None = None, all_months: bool = True,
                  partitioned: bool = False, state: str | None = None) -> dict[str, DataFrame]:
    """R-7: the three reports of the full run. The exposure report reads every month (R-2);
    the request reports read the run day's month (R-4, R-6), as in the reference.

    ``partitioned``: the logs were written by the conversion job, and only the month's
    partitions of the request log are read. ``state``: a folder where the exposure report keeps
    per-file parts, so a run reads only new log files (``plans.incremental``)."""
    run = run or logs.yesterday()
    if partitioned:
        requests = logs.read_partitioned(spark, request_root, schemas.REQUEST_LOG).filter(F.col("local-month") == run.month)
    else:
        requests = logs.read_month(spark, request_root, run.month, schemas.REQUEST_LOG)
    success, fail = reports.request_reports_all(with_ord(requests), ssp_tag, orders)
    if state and all_months:
        kept = IncrementalExposure(state, "parquet" if partitioned else "json")
        kept.update(spark, exposure_root)
        bg = kept.report(spark, ssp_tag)
    else:
        read = logs.read_partitioned if partitioned else logs.read_all
        bg = reports.exposure_report_all(with_ord(read(spark, exposure_root, schemas.EXPOSURE_LOG)), ssp_tag,
                                         months=None if all_months else [run.month])
    return {
        "bg": bg,
        "success": success,
        "fail": fail,
    }


# R-1, R-3, R-5: (schema, report) of one run day.
DAILY = {"bg": (schemas.EXPOSURE_LOG, reports.exposure_report_daily),
         "success": (schemas.REQUEST_LOG, reports.success_report_daily),
         "fail": (schemas.REQUEST_LOG, reports.failure_report_daily)}


def build_daily(spark: SparkSession, kind: str, logs_root: str, ssp_tag: DataFrame, run: reports.RunDay,
                partitioned: bool = False) -> DataFrame:
    """One daily report from a month's JSON file, or from the converted log, of which only
    the run day's partition is read."""
    schema, report = DAILY[kind]
    log = logs.read_partitioned(spark, logs_root, schema) if partitioned else logs.read_month(spark, logs_root, run.month, schema)
    return report(with_ord(log), ssp_tag, run)


def with_ord(log: DataFrame) -> DataFrame:
    """Tie-break for ``first`` on raw logs: (file, position in file).

    Parquet exposes the row index, a deterministic column, so later filters still
    reach the scan (partition pruning). JSON has none; the row id stands in, which
    keeps later filters above it (read one month's file there instead)."""
    meta = log.select("_metadata").schema["_metadata"].dataType.fieldNames()
    pos = F.col("_metadata.row_index") if "row_index" in meta else F.monotonically_increasing_id()
    return log.withColumn("event_id", F.struct(F.col("_metadata.file_path").alias("f"), pos.alias("i")))


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all keys, rows with a null key): the second cannot be stored under a key
    and is reported instead (D15)."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return df.filter(whole), df.filter(~whole)


def upsert_reports(spark: SparkSession, built: dict[str, DataFrame], table_root: str) -> dict[str, str]:
    """K-1 a: merge each report into its keyed table ``<root>/<name>``, stored as parquet
    partitioned by ``daytime``; only the days a run produced are read and rewritten. Rows
    with a null key go to ``<root>/<name>_null_keys``, which holds the last run's.
    The report itself is computed once. Returns the table paths."""
    out = {}
    for name, df in built.items():
        keys, measures = REPORT_KEYS[name]
        path = os.path.join(table_root, name)
        staging = scratch_path(spark, f"staging-{name}")
        df.write.parquet(f"{staging}-report")
        keyed, unkeyed = split_null_keys(spark.read.schema(df.schema).parquet(f"{staging}-report"), keys)
        unkeyed.write.mode("overwrite").parquet(f"{path}_null_keys")
        merge.merge_partitions(spark, path, keyed, keys, measures, "daytime", staging)
        out[name] = path
    return out


def write_reports_dbapi(built: dict[str, DataFrame], connect, tables: dict[str, str]) -> None:
    """K-1 b: the reference's INSERT ... ON DUPLICATE KEY UPDATE per partition."""
    for name, df in built.items():
        keys, measures = REPORT_KEYS[name]
        attrs = [c for c in df.columns if c not in keys and c not in measures]
        sql = writers.upsert_sql(tables[name], keys, measures, attrs, placeholder="%s")
        writers.write_partitions_dbapi(df.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys)), connect, sql,
                                       [*keys, *attrs, *measures], null_to_zero=("is_compensate",))


def write_reports_staged(spark: SparkSession, built: dict[str, DataFrame], connect: str, tables: dict[str, str], null_root: str,
                         placeholder: str = "%s") -> None:
    """K-1 b with each report as one transaction: loaded into ``<table>_staging``, merged by one commit.
    Rows with a null key go to ``<null_root>/<name>_null_keys``, as in the table form."""
    for name, df in built.items():
        keys, measures = REPORT_KEYS[name]
        staging = scratch_path(spark, f"staged-{name}")
        df.write.parquet(staging)  # the report is computed once
        keyed, unkeyed = split_null_keys(spark.read.schema(df.schema).parquet(staging), keys)
        unkeyed.write.mode("overwrite").parquet(os.path.join(null_root, f"{name}_null_keys"))
        if "is_compensate" in keyed.columns:
            keyed = keyed.withColumn("is_compensate", F.coalesce("is_compensate", F.lit(0)))
        dbapi.upsert_dbapi(keyed, connect, tables[name], f"{tables[name]}_staging", keys, measures, placeholder)


def segment_and_store(spark: SparkSession, seats: DataFrame, usable: DataFrame, out_path: str,
                      tie: str = "sid", max_items: int | None = None, rejected_path: str | None = None) -> str:
    """R-11: usable intervals -> segments -> JSON documents with stable ids.

    Intervals whose times cannot be parsed or are inverted are written to ``rejected_path``
    (``<out_path>_rejected`` by default) with the reason; the path is returned.
    ``max_items`` bounds the active intervals of one document (``segments.segments``)."""
    rejected_path = rejected_path or out_path.rstrip("/") + "_rejected"
    padded = checkpointed(segments.pad(segments.join_usable(seats, usable, tie)))
    segments.rejected(padded).drop("b", "e").write.mode("overwrite").json(rejected_path)
    docs = segments.to_documents(segments.segment_intervals(segments.valid(padded), max_items))
    writers.write_documents(docs.select("doc_id", "doc"), out_path)
    return rejected_path


def start_exposure_counter(spark: SparkSession, raw_stream: DataFrame, out_path: str, checkpoint: str,
                           trigger: dict | None = None):
    """R-8, totals only: state-store day totals, replay-safe batch sink."""
    q, _ = deal_stream.run_deal_totals(spark, raw_stream, out_path, checkpoint,
                                       trigger or {"processingTime": BATCH_INTERVAL}, day_mode="processing")
    return q


def start_exposure_control(spark: SparkSession, raw_stream: DataFrame, state_path: str, caps: DataFrame,
                           checkpoint: str, trigger: dict | None = None, kv_connect=None, day=None,
                           initial: DataFrame | None = None, counter_path: str | None = None):
    """R-8 whole: in every micro-batch count exposures, add them to the day totals and (if
    given) the KV counters, compare with the caps, and set ``stop = 1`` on the stored cap
    table. With ``counter_path`` the KV counters are exactly-once: epochs are kept there and the
    store gets values. Returns (query, sink): ``sink.current(spark)`` holds the totals and
    ``sink.current_caps(spark)`` the cap table."""
    sink = deal_stream.ReadAddWriteSink(state_path, caps, os.path.join(state_path, "_flags"), day=day,
                                        initial=initial, kv_connect=kv_connect, store_caps=True,
                                        counters=EpochCounters(counter_path) if counter_path else None)
    return deal_stream.run_read_add_write(spark, raw_stream, sink, checkpoint, trigger), sink
