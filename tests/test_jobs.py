"""End-to-end jobs on JSON logs written from TESTDATA."""

import os

from pyspark.sql import functions as F

from adlens.operators import reports
from adlens.plans import jobs
from adlens.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_report_run_all_from_json_logs(spark, tmp_out):
    exp_root, req_root = os.path.join(tmp_out, "bg"), os.path.join(tmp_out, "req")
    td.exposure_log(spark, SF).drop("event_id").write.json(exp_root)
    req = td.request_log(spark, SF).drop("event_id", "ts")
    # one file per month, named <yyyyMM>.log, as the request reports expect
    req.coalesce(1).write.json(os.path.join(tmp_out, "req_tmp"))
    os.makedirs(req_root)
    part = [f for f in os.listdir(os.path.join(tmp_out, "req_tmp")) if f.startswith("part-")][0]
    os.rename(os.path.join(tmp_out, "req_tmp", part), os.path.join(req_root, "202401.log"))

    built = jobs.build_reports(spark, exp_root, req_root, td.ssp_tag(spark, SF), td.adx_order_dealid(spark, SF),
                               run=reports.RunDay("20240131"))
    n_views = td.exposure_log(spark, SF).count()
    assert built["bg"].agg(F.sum("total")).first()[0] == n_views
    req_all = td.request_log(spark, SF)
    assert built["success"].agg(F.sum("total")).first()[0] == req_all.filter("isHaveAd = 1").count()
    assert built["fail"].agg(F.sum("total")).first()[0] == req_all.filter("isHaveAd = 0").count()

    paths = jobs.upsert_reports(spark, built, os.path.join(tmp_out, "tables"))
    first = spark.read.parquet(paths["bg"])
    assert first.count() == built["bg"].count()


def test_segment_and_store_writes_documents(spark, tmp_out):
    out = os.path.join(tmp_out, "docs")
    jobs.segment_and_store(spark, td.ad_seat(spark, SF), td.usable_media(spark, SF), out)
    docs = spark.read.json(out)
    assert docs.count() > 0 and docs.select("doc_id").distinct().count() == docs.count()


def test_merge_partitions_rewrites_only_touched_days(spark, tmp_out):
    from adlens.sinks import merge
    target = os.path.join(tmp_out, "t")
    first = spark.createDataFrame([("a", "d1", 1), ("b", "d1", 2), ("a", "d2", 3)], "k string, day string, m long")
    merge.merge_partitions(spark, target, first, ["k", "day"], ["m"], "day", os.path.join(tmp_out, "s1"))
    d1_files = sorted(os.listdir(os.path.join(target, "day=d1")))
    upd = spark.createDataFrame([("a", "d2", 30), ("c", "d2", 5), ("z", "d3", 9)], "k string, day string, m long")
    merge.merge_partitions(spark, target, upd, ["k", "day"], ["m"], "day", os.path.join(tmp_out, "s2"))
    got = sorted((r["k"], r["day"], r["m"]) for r in spark.read.parquet(target).collect())
    assert got == [("a", "d1", 1), ("a", "d2", 30), ("b", "d1", 2), ("c", "d2", 5), ("z", "d3", 9)]
    assert sorted(os.listdir(os.path.join(target, "day=d1"))) == d1_files  # untouched partition


def test_with_ord_keeps_partition_pruning_on_parquet_logs(spark, tmp_out):
    from adlens import schemas
    from adlens.sources import logs
    out = os.path.join(tmp_out, "pq")
    td.exposure_log(spark, SF).drop("event_id").write.partitionBy("local-month", "local-day").parquet(out)
    log = jobs.with_ord(logs.read_partitioned(spark, out, schemas.EXPOSURE_LOG))
    day = reports.exposure_report_daily(log, td.ssp_tag(spark, SF), reports.RunDay("20240105"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # plan text not cut short
    try:
        plan = day._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    import re
    filters = [seg[:300] for seg in plan.split("PartitionFilters: ")[1:]]
    assert any(re.match(r"\[[^\]]*\(local-day#\d+ = 05\)", f) for f in filters), filters
    n = td.exposure_log(spark, SF).filter(F.col("local-day") == "05").count()
    assert day.agg(F.sum("total")).first()[0] == n


def test_reports_run_three_times_are_stored_once(spark, tmp_out):
    reads = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            reads.add(1)
            yield r

    schema = "dealid string, daytime string, media_id string, total long"
    rows = [("a", "2024-01-01", "m", 3), (None, "2024-01-01", "m", 2), ("b", None, "m", 1), ("c", "20240102", None, 4)]
    fail = "dsp_id string, daytime string, `return` long, timeout long, else_error long, total long"
    for _ in range(3):
        source = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).mapPartitions(counted), schema)
        built = {"bg": source, "fail": spark.createDataFrame([("x", "d1", 1, 2, 3, 6), (None, "d1", 1, 1, 1, 3)], fail)}
        before = reads.value
        paths = jobs.upsert_reports(spark, built, os.path.join(tmp_out, "tables"))
        assert reads.value - before == len(rows)  # the report is computed once
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(paths["bg"]).select("dealid", "daytime", "total").collect())
    assert got == [("a", "2024-01-01", 3), ("c", "20240102", 4)]
    assert spark.read.parquet(paths["bg"] + "_null_keys").agg(F.sum("total")).first()[0] == 3
    assert spark.read.parquet(paths["fail"]).count() == 1 and spark.read.parquet(paths["fail"] + "_null_keys").count() == 1


def test_upsert_matches_null_keys(spark):
    from adlens.sinks import merge
    schema = "k string, day string, m long"
    target = spark.createDataFrame([(None, "d1", 1), ("a", None, 2)], schema)
    updates = spark.createDataFrame([(None, "d1", 5), ("a", None, 7), (None, None, 9)], schema)
    got = {(r["k"], r["day"]): r["m"] for r in merge.upsert(target, updates, ["k", "day"], ["m"]).collect()}
    assert got == {(None, "d1"): 5, ("a", None): 7, (None, None): 9}


def test_segment_and_store_reports_rejected_intervals(spark, tmp_out):
    # the adapter's own unusable times left out: the rejected ones below are all there are
    seats = td.ad_seat(spark, SF).filter("try_cast(ad_seat_e_time AS BIGINT) >= try_cast(ad_seat_b_time AS BIGINT)")
    out = os.path.join(tmp_out, "docs")
    bad = (seats.limit(2).withColumn("ad_seat_b_time", F.lit("soon"))
           .unionByName(seats.limit(3).withColumn("ad_seat_e_time", F.lit("-999999"))))
    videos = seats.select("video_id").distinct()
    path = jobs.segment_and_store(spark, seats.unionByName(bad), videos, out, max_items=2)
    why = {r["status"]: r["count"] for r in spark.read.json(path).groupBy("status").count().collect()}
    kept = bad.filter(F.col("class_type_id").isin("1", "2", "3", "4"))
    assert sum(why.values()) == kept.count() > 0 and set(why) <= {"bad_time", "inverted"}
    docs = spark.read.json(out)
    assert docs.select("doc_id").distinct().count() == docs.count()
    parts = docs.select(F.get_json_object("doc", "$.part").alias("part"))
    assert parts.filter("part > 0").count() > 0


def test_exposure_control_sets_stop_over_micro_batches(spark, tmp_out):
    from adlens.sources.streams import open_log_stream
    rec = '{"dealid":"%s","sltcustomtopic":"sltadxlog-adx-bg"}'
    for i in range(3):
        rows = [(rec % "7", "2024-01-01")] * 20 + [(rec % "8", "2024-01-01")] * 5
        spark.createDataFrame(rows, "value string, ts string").coalesce(1).write.parquet(os.path.join(tmp_out, "src", f"p{i}"))
    raw = open_log_stream(spark, "parquet", os.path.join(tmp_out, "src", "*"), schema="value string, ts string", options={"maxFilesPerTrigger": "1"})
    caps = spark.createDataFrame([("7", "2024-01-01", 80, 0), ("8", "2024-01-01", 80, 0), ("9", "2024-01-01", 0, 1)],
                                 "dealid string, now_time string, dealidnum int, stop int")
    q, sink = jobs.start_exposure_control(spark, raw, os.path.join(tmp_out, "state"), caps, os.path.join(tmp_out, "ckpt"),
                                          {"availableNow": True}, day=F.col("ts"))
    q.awaitTermination()
    assert sink.last_applied(spark) == 2
    assert {r["dealid"]: r["total"] for r in sink.current(spark).collect()} == {"7": 60, "8": 15}
    assert {r["dealid"]: r["stop"] for r in sink.current_caps(spark).collect()} == {"7": 1, "8": 0, "9": 1}


def test_reports_through_a_db_api_connection(spark, tmp_out):
    class FileDb:  # DB-API stand-in: keeps what a partition committed in a file
        def cursor(self):
            self.done = []
            return self

        def executemany(self, sql, rows):
            self.done += [[sql, *r] for r in rows]

        def commit(self):
            import json
            import uuid
            with open(os.path.join(tmp_out, f"db-{uuid.uuid4().hex}.json"), "w") as f:
                json.dump(self.done, f)

        def rollback(self):
            pass

        def close(self):
            pass

    bg = spark.createDataFrame([("a", "d1", "m", 3), (None, "d1", "m", 2), ("b", None, "m", 1)], "dealid string, daytime string, media_id string, total long")
    fail = spark.createDataFrame([("x", "d1", 1, 2, 3, 6)], "dsp_id string, daytime string, `return` long, timeout long, else_error long, total long")
    jobs.write_reports_dbapi({"bg": bg, "fail": fail}, FileDb, {"bg": "t_bg", "fail": "t_fail"})
    import glob
    import json
    rows = [r for p in glob.glob(os.path.join(tmp_out, "db-*.json")) for r in json.load(open(p))]
    assert sorted(r[1:] for r in rows) == [["a", "d1", "m", 3], ["x", "d1", 1, 2, 3, 6]]
    assert all("ON DUPLICATE KEY UPDATE" in r[0] for r in rows) and {r[0].split("(")[0] for r in rows} == {"INSERT INTO t_bg", "INSERT INTO t_fail"}
