"""Command-line entry points, one per job of the reference (for ``spark-submit``).

    spark-submit adlens/plans/cli.py reports   --exposure-logs P --request-logs P --ssp-tag T --orders T --out P [--partitioned] [--state P] [--dbapi M:F]
    spark-submit adlens/plans/cli.py success   --request-logs P --ssp-tag T --orders T --out P [--day yyyyMMdd]
    spark-submit adlens/plans/cli.py counter   --stream-format kafka --stream-options J --out P --checkpoint P [--available-now] [--caps T [--kv M:F]] [--stop-file P]
    spark-submit adlens/plans/cli.py parse     --stream-format kafka --stream-options J --out P --checkpoint P [--available-now]
    spark-submit adlens/plans/cli.py convert   --logs P --kind exposure|request --out P [--months yyyyMM,...]
    spark-submit adlens/plans/cli.py daily     --logs P --kind bg|success|fail --ssp-tag T [--partitioned] --out P [--day yyyyMMdd]
    spark-submit adlens/plans/cli.py segment   --seats T --usable T --out P [--max-items N]

A table argument ``T`` is a path (format from ``--table-format``, parquet by
default) or ``jdbc:<options.json>`` whose file holds ``jdbc_options`` keys. ``M:F`` names a
connection factory, ``package.module:function``.
Hosts and credentials come from those files, never from code.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from adlens import schemas  # noqa: E402
from adlens.fixed import BATCH_INTERVAL  # noqa: E402
from adlens.operators import reports  # noqa: E402
from adlens.plans import jobs  # noqa: E402
from adlens.sources import logs  # noqa: E402
from adlens.sources.streams import open_log_stream  # noqa: E402
from adlens.sinks import dbapi  # noqa: E402
from adlens.streaming import deal_stream, lifecycle  # noqa: E402


def load_table(spark: SparkSession, arg: str, fmt: str) -> DataFrame:
    if arg.startswith("jdbc:"):
        with open(arg[5:]) as f:
            return spark.read.format("jdbc").options(**json.load(f)).load()
    return spark.read.format(fmt).load(arg)


def _stream(spark: SparkSession, a) -> DataFrame:
    opts = json.loads(a.stream_options) if a.stream_options else {}
    if a.stream_format == "kafka":
        return open_log_stream(spark, "kafka", options=opts)
    # File sources replay records with the same ``value`` text column.
    return open_log_stream(spark, a.stream_format, a.stream_path, schema=schemas.RAW_RECORD, options=opts)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="adlens")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("reports", "success"):
        s = sub.add_parser(name)
        if name == "reports":
            s.add_argument("--exposure-logs", required=True)
            s.add_argument("--partitioned", action="store_true", help="both logs were written by convert")
            s.add_argument("--state", help="folder of per-file parts: the exposure report reads only new log files")
            s.add_argument("--dbapi", help="connection factory: upsert into tables (--tables) in one transaction each; --out gets rows with null keys")
            s.add_argument("--tables", help="JSON: table names by report (bg, success, fail)")
            s.add_argument("--placeholder", default="%s", help="of the driver's statements (default %(default)s)")
        s.add_argument("--request-logs", required=True)
        s.add_argument("--ssp-tag", required=True)
        s.add_argument("--orders", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--day", help="report day yyyyMMdd (default: yesterday)")
        s.add_argument("--table-format", default="parquet")
    for name in ("counter", "parse"):
        s = sub.add_parser(name)
        s.add_argument("--stream-format", default="kafka")
        s.add_argument("--stream-options")
        s.add_argument("--stream-path")
        s.add_argument("--out", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--available-now", action="store_true",
                       help="process what is available, then stop (scheduled runs)")
        s.add_argument("--stop-file", help="stop after the running batch once this file exists")
        s.add_argument("--poll", type=float, default=5.0, help="seconds between looks at the stop file")
        if name == "counter":
            s.add_argument("--caps", help="cap table: also keep totals, check caps and set stop flags (state in --out)")
            s.add_argument("--kv", help="factory of a KV client (set, close): with --caps, counters are published to it, each batch once")
            s.add_argument("--compact-every", type=int, default=1000, help="batches and idle triggers between snapshots of the totals")
            s.add_argument("--table-format", default="parquet")
    s = sub.add_parser("convert")
    s.add_argument("--logs", required=True)
    s.add_argument("--kind", choices=("exposure", "request"), required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--months")
    s.add_argument("--files-per-day", type=int, default=8)
    s = sub.add_parser("daily")
    s.add_argument("--logs", required=True)
    s.add_argument("--kind", choices=tuple(jobs.DAILY), required=True)
    s.add_argument("--ssp-tag", required=True)
    s.add_argument("--partitioned", action="store_true", help="--logs was written by convert")
    s.add_argument("--out", required=True)
    s.add_argument("--day", help="report day yyyyMMdd (default: yesterday)")
    s.add_argument("--table-format", default="parquet")
    s = sub.add_parser("segment")
    s.add_argument("--seats", required=True)
    s.add_argument("--usable", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--max-items", type=int, help="at most so many active intervals in one document")
    s.add_argument("--table-format", default="parquet")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"adlens-{a.job}").getOrCreate()
    if a.job in ("reports", "success"):
        run = reports.RunDay.parse(a.day) if a.day else logs.yesterday()
        tags, orders = load_table(spark, a.ssp_tag, a.table_format), load_table(spark, a.orders, a.table_format)
        if a.job == "reports":
            built = jobs.build_reports(spark, a.exposure_logs, a.request_logs, tags, orders, run, partitioned=a.partitioned, state=a.state)
        else:
            req = jobs.with_ord(logs.read_month(spark, a.request_logs, run.month, schemas.REQUEST_LOG))
            built = {"success": reports.success_report_all(req, tags, orders)}
        if a.job == "reports" and a.dbapi:
            jobs.write_reports_staged(spark, built, a.dbapi, json.loads(a.tables), a.out, a.placeholder)
        else:
            jobs.upsert_reports(spark, built, a.out)
    elif a.job == "convert":
        schema = schemas.EXPOSURE_LOG if a.kind == "exposure" else schemas.REQUEST_LOG
        logs.to_partitioned(spark, a.logs, a.out, schema, a.months.split(",") if a.months else None,
                            files_per_day=a.files_per_day)
    elif a.job == "daily":
        run = reports.RunDay.parse(a.day) if a.day else logs.yesterday()
        built = jobs.build_daily(spark, a.kind, a.logs, load_table(spark, a.ssp_tag, a.table_format), run, a.partitioned)
        jobs.upsert_reports(spark, {a.kind: built}, a.out)
    elif a.job in ("counter", "parse"):
        trigger = {"availableNow": True} if a.available_now else {"processingTime": BATCH_INTERVAL}
        if a.job == "counter" and a.caps:
            q, _ = jobs.start_exposure_control(spark, _stream(spark, a), a.out, load_table(spark, a.caps, a.table_format), a.checkpoint, trigger,
                                               kv_connect=dbapi.factory(a.kv) if a.kv else None,
                                               counter_path=os.path.join(a.out, "_counters") if a.kv else None)
        elif a.job == "counter":
            q = jobs.start_exposure_counter(spark, _stream(spark, a), a.out, a.checkpoint, trigger)
        else:
            q, _ = deal_stream.run_parse_stream(spark, _stream(spark, a).withColumn("event_id", _no_id()),
                                                a.out, a.checkpoint, trigger)
        totals = a.out if a.job == "counter" and not a.caps else None
        lifecycle.run_until_stopped(spark, q, a.stop_file, totals, getattr(a, "compact_every", 1000), a.poll)
    else:
        seats = load_table(spark, a.seats, a.table_format)
        usable = load_table(spark, a.usable, a.table_format)
        # Without a row id the tie-break is the full row (identical rows are interchangeable).
        seats = seats.withColumn("sid", _row_struct(seats))
        jobs.segment_and_store(spark, seats, usable, a.out, max_items=a.max_items)


def _no_id():
    from pyspark.sql import functions as F
    return F.lit(None).cast("long")


def _row_struct(df: DataFrame):
    from pyspark.sql import functions as F
    return F.struct(*[F.col(c) for c in df.columns])


if __name__ == "__main__":
    main()
