"""The command-line jobs on files written from TESTDATA."""

import os

from pyspark.sql import functions as F

from adlens.plans import cli
from adlens.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_segment_job(spark, tmp_out):
    seats, usable = os.path.join(tmp_out, "seats"), os.path.join(tmp_out, "usable")
    td.ad_seat(spark, SF).drop("sid").write.parquet(seats)
    td.usable_media(spark, SF).write.parquet(usable)
    cli.main(["segment", "--seats", seats, "--usable", usable, "--out", os.path.join(tmp_out, "docs")])
    docs = spark.read.json(os.path.join(tmp_out, "docs"))
    assert docs.count() > 0


def test_success_job(spark, tmp_out):
    req = os.path.join(tmp_out, "req")
    td.request_log(spark, SF).drop("event_id", "ts").coalesce(1).write.json(os.path.join(tmp_out, "tmp"))
    os.makedirs(req)
    part = [f for f in os.listdir(os.path.join(tmp_out, "tmp")) if f.startswith("part-")][0]
    os.rename(os.path.join(tmp_out, "tmp", part), os.path.join(req, "202401.log"))
    tags, orders = os.path.join(tmp_out, "tags"), os.path.join(tmp_out, "orders")
    td.ssp_tag(spark, SF).write.parquet(tags)
    td.adx_order_dealid(spark, SF).write.parquet(orders)
    out = os.path.join(tmp_out, "tables")
    cli.main(["success", "--request-logs", req, "--ssp-tag", tags, "--orders", orders, "--out", out,
              "--day", "20240131"])
    got = spark.read.parquet(os.path.join(out, "success"))
    assert got.agg(F.sum("total")).first()[0] == td.request_log(spark, SF).filter("isHaveAd = 1").count()


def test_stream_jobs_on_a_file_source(spark, tmp_out):
    src = os.path.join(tmp_out, "records")
    td.raw_stream(spark, SF).select("value", F.col("ts").cast("timestamp").alias("ts")).write.json(src)
    common = ["--stream-format", "json", "--stream-path", src, "--available-now"]
    cli.main(["parse", *common, "--out", os.path.join(tmp_out, "parsed"), "--checkpoint", os.path.join(tmp_out, "c1")])
    assert spark.read.parquet(os.path.join(tmp_out, "parsed")).count() == td.raw_stream(spark, SF).count()
    cli.main(["counter", *common, "--out", os.path.join(tmp_out, "totals"), "--checkpoint", os.path.join(tmp_out, "c2")])
    from adlens.operators import counters
    from adlens.streaming import deal_stream
    got = deal_stream.latest_totals(spark, os.path.join(tmp_out, "totals"))
    assert got.agg(F.sum("total")).first()[0] == counters.keep_topic(td.raw_stream(spark, SF)).count()


def test_convert_and_daily_jobs(spark, tmp_out):
    logs_root, pq, out = (os.path.join(tmp_out, d) for d in ("logs", "pq", "tables"))
    td.exposure_log(spark, SF).drop("event_id").coalesce(1).write.json(os.path.join(tmp_out, "tmp"))
    os.makedirs(logs_root)
    part = [f for f in os.listdir(os.path.join(tmp_out, "tmp")) if f.startswith("part-")][0]
    os.rename(os.path.join(tmp_out, "tmp", part), os.path.join(logs_root, "202401.log"))
    # Small days are merged into one task by adaptive execution; here each part stays its own.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cli.main(["convert", "--logs", logs_root, "--kind", "exposure", "--out", pq, "--files-per-day", "4"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    day = os.path.join(pq, "local-month=202401", "local-day=05")
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) > 1  # a day is several tasks' work
    tags = os.path.join(tmp_out, "tags")
    td.ssp_tag(spark, SF).write.parquet(tags)
    want = td.exposure_log(spark, SF).filter("`local-day` = '05' and dealid is not null").count()
    for i, how in enumerate((["--logs", logs_root], ["--logs", pq, "--partitioned"])):
        cli.main(["daily", "--kind", "bg", "--ssp-tag", tags, "--day", "20240105", "--out", f"{out}{i}", *how])
        assert spark.read.parquet(os.path.join(f"{out}{i}", "bg")).agg(F.sum("total")).first()[0] == want


def logs_of(spark, tmp_out):
    """Month logs of both kinds as JSON, their converted forms, and the two lookup tables."""
    paths = {k: os.path.join(tmp_out, k) for k in ("exposure", "request", "exposure-pq", "request-pq", "tags", "orders")}
    for kind, log in (("exposure", td.exposure_log(spark, SF).drop("event_id")), ("request", td.request_log(spark, SF).drop("event_id", "ts"))):
        tmp = os.path.join(tmp_out, f"tmp-{kind}")
        log.coalesce(1).write.json(tmp)
        os.makedirs(paths[kind])
        part = [f for f in os.listdir(tmp) if f.startswith("part-")][0]
        os.rename(os.path.join(tmp, part), os.path.join(paths[kind], "202401.log"))
        cli.main(["convert", "--logs", paths[kind], "--kind", kind, "--out", paths[f"{kind}-pq"]])
    td.ssp_tag(spark, SF).write.parquet(paths["tags"])
    td.adx_order_dealid(spark, SF).write.parquet(paths["orders"])
    return paths


def test_reports_from_the_converted_log_and_from_parts(spark, tmp_out):
    """The same totals from JSON, from the converted log, and from per-file parts of either; a second run
    with parts reads no log file again."""
    p = logs_of(spark, tmp_out)
    tables = ["--ssp-tag", p["tags"], "--orders", p["orders"], "--day", "20240131"]
    json_logs, pq_logs = (["--exposure-logs", p["exposure" + x], "--request-logs", p["request" + x]] for x in ("", "-pq"))
    state = lambda k: ["--state", os.path.join(tmp_out, f"state{k}")]
    runs = [json_logs, [*pq_logs, "--partitioned"], [*json_logs, *state(1)], [*pq_logs, "--partitioned", *state(2)], [*json_logs, *state(1)]]
    sums = []
    for k, how in enumerate(runs):
        out = os.path.join(tmp_out, f"out{k}")
        cli.main(["reports", *how, *tables, "--out", out])
        read = lambda name: spark.read.option("mergeSchema", "true").parquet(os.path.join(out, name))
        sums.append({n: (read(n).count(), read(n).agg(F.sum("total")).first()[0]) for n in ("bg", "success", "fail")})
        sums[-1]["bg days"] = sorted(map(tuple, read("bg").groupBy("daytime").agg(F.sum("total"), F.count("*")).collect()), key=str)
    assert all(x == sums[0] for x in sums[1:]) and sums[0]["bg"][0] > 0
    assert len(os.listdir(os.path.join(tmp_out, "state1", "_ledger"))) == 1


def test_stop_file_and_idle_compaction(spark, tmp_out):
    """A counter that would run for ever stops at the stop file; its totals are compacted while it is idle."""
    import threading
    import time
    from adlens.streaming import deal_stream
    src, out, stop = (os.path.join(tmp_out, d) for d in ("records", "totals", "stop"))
    td.raw_stream(spark, SF).select("value", F.col("ts").cast("timestamp").alias("ts")).write.json(src)
    snaps = os.path.join(out, deal_stream.SNAPSHOTS)

    def stop_when_compacted():
        for _ in range(600):
            if os.path.isdir(snaps) and any(d.startswith("snap") for d in os.listdir(snaps)):
                break
            time.sleep(0.2)
        open(stop, "w").close()

    waiter = threading.Thread(target=stop_when_compacted)
    waiter.start()
    cli.main(["counter", "--stream-format", "json", "--stream-path", src, "--out", out, "--checkpoint", os.path.join(tmp_out, "c"),
              "--stop-file", stop, "--poll", "0.5", "--compact-every", "2"])
    waiter.join()
    assert any(d.startswith("snap") for d in os.listdir(snaps))
    assert not spark.streams.active
    from adlens.operators import counters
    assert deal_stream.latest_totals(spark, out).agg(F.sum("total")).first()[0] == counters.keep_topic(td.raw_stream(spark, SF)).count()


def test_control_loop_publishes_counters_once(spark, tmp_out):
    """--kv: the KV store holds the counters' values after a run and after a rerun of nothing."""
    import sys
    kv = os.path.join(tmp_out, "kv")
    os.makedirs(kv)
    module = os.path.join(tmp_out, "file_kv.py")
    with open(module, "w") as f:
        f.write(f"""
import os

class Client:
    def set(self, key, value):
        with open(os.path.join({kv!r}, key), "w") as f:
            f.write(str(value))

    def close(self):
        pass
""")
    spark.sparkContext.addPyFile(module)
    sys.path.insert(0, tmp_out)
    src, caps = os.path.join(tmp_out, "records"), os.path.join(tmp_out, "caps")
    td.raw_stream(spark, SF).select("value", F.col("ts").cast("timestamp").alias("ts")).write.json(src)
    td.deal_caps(spark, SF).write.parquet(caps)
    for _ in range(2):
        cli.main(["counter", "--stream-format", "json", "--stream-path", src, "--available-now", "--caps", caps, "--kv", "file_kv:Client",
                  "--out", os.path.join(tmp_out, "control"), "--checkpoint", os.path.join(tmp_out, "c")])
    sys.path.remove(tmp_out)
    from adlens.operators import counters
    want = {f"adxhappen:{r['dealid'] or 'null'}": r["total"] for r in counters.deal_counts(counters.keep_topic(td.raw_stream(spark, SF))).collect()}
    assert {k: int(open(os.path.join(kv, k)).read()) for k in os.listdir(kv)} == want
