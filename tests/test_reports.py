"""Report semantics on hand-made frames (D1, D3, D6, F-3, F-4, P-8)."""

from pyspark.sql import functions as F

from adlens.functions import scalar as fx
from adlens.operators import reports
from adlens.operators.lookup import left_lookup
from adlens.sources.testdata import request_log

LOG = ("event_id long, dealid string, `local-month` string, `local-day` string, order_id string, "
       "main_order_id string, media_channel_id string, tag_id string, adx_material_id string, "
       "dsp_id string, advertiser_id string")


def exposure(spark, rows):
    return spark.createDataFrame(rows, LOG)


def test_first_is_the_row_with_smallest_ord_nulls_kept(spark):
    log = exposure(spark, [
        (2, "d1", "202401", "05", "o1", "o1", "3", "3_scene_view", "m", "10001", "a"),
        (1, "d1", "202401", "05", "o9", None, "3", None, "m", "10001", "a"),
    ])
    tags = spark.createDataFrame([("3", "CHINA")], "channel_id string, media_id string")
    r = reports.exposure_report_all(log, tags).collect()[0]
    assert (r["order_id"], r["main_order_id"], r["tag_id"], r["tag_id_channel"]) == ("o9", None, None, None)
    assert r["is_compensate"] == 1 and r["total"] == 2
    assert r["daytime"] == "2024-01-05" and r["media_id"] == "CHINA"


def test_int_media_id_default_is_text(spark):
    fact = spark.createDataFrame([("x",)], "media_channel_id string")
    dim = spark.createDataFrame([("y", 7)], "channel_id string, media_id int")
    out = left_lookup(fact, dim, "media_channel_id", "channel_id", {"media_id": "media_id"}, {"media_id": "000"})
    assert out.collect()[0]["media_id"] == "000"


def test_duplicate_dimension_rows_fan_out(spark):
    fact = spark.createDataFrame([("1",)], "media_channel_id string")
    dim = spark.createDataFrame([("1", "A"), ("1", "B")], "channel_id string, media_id string")
    out = left_lookup(fact, dim, "media_channel_id", "channel_id", {"media_id": "media_id"})
    assert sorted(r["media_id"] for r in out.collect()) == ["A", "B"]


def test_scalar_edge_cases(spark):
    df = spark.createDataFrame([("a_b_c", "x", "x"), ("abc", None, "y"), ("ab_", "z", "w"), (None, "q", "q")],
                               "s string, a string, b string")
    rows = df.select(fx.last_part("s").alias("p"), fx.differs_flag("a", "b").alias("f")).collect()
    assert [(r["p"], r["f"]) for r in rows] == [("c", 0), ("abc", 1), ("", 1), (None, 0)]


def test_daily_reports_filter_one_day(spark):
    log = request_log(spark, "/root/testdata/sf0.001")
    tags = spark.createDataFrame([], "channel_id string, media_id string")
    day = reports.RunDay.parse("2024-01-15")
    fail = reports.failure_report_daily(log, tags, day)
    assert set(r["daytime"] for r in fail.collect()) <= {"20240115"}
    for r in fail.collect():
        assert r["else_error"] == r["total"] - r["return"] - r["timeout"]
        assert r["media_id"] == "000"
    n_all = log.filter((F.col("isHaveAd") == 0) & (F.col("local-day") == "15")).count()
    assert sum(r["total"] for r in fail.collect()) == n_all


def test_cluster_conf_scales_partitions():
    from adlens.session import cluster_conf
    conf = cluster_conf(100 * 10**12)
    assert 50_000 < int(conf["spark.sql.shuffle.partitions"]) <= 100_000
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(10**6)["spark.sql.shuffle.partitions"]) == 200


def test_json_fields_and_hyphenated_columns(spark):
    doc = '{"tag_id":"Scene_3_view","dsp_id":10001,"advertiser_id":"adv1","size":{"w":640,"h":360},"tags":["a","b"]}'
    df = spark.createDataFrame([(doc, "2024", "01")], "info string, `b-b` string, `local-day` string")
    r = df.select(fx.json_field("info", "dsp_id").alias("dsp"), fx.json_field("info", "size.w").alias("w"),
                  fx.json_field("info", "tags[1]").alias("t"), fx.json_field("info", "missing").alias("m"),
                  F.concat(F.col("b-b"), F.lit("-"), F.col("local-day")).alias("c")).first()
    assert (r["dsp"], r["w"], r["t"], r["m"], r["c"]) == ("10001", "640", "b", None, "2024-01")


def test_one_scan_request_reports_equal_separate_reports(spark):
    from adlens.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    log, tags, orders = td.request_log(spark, sf), td.ssp_tag(spark, sf), td.adx_order_dealid(spark, sf)
    succ, fail = reports.request_reports_all(log, tags, orders)
    want_s, want_f = reports.success_report_all(log, tags, orders), reports.failure_report_all(log, tags)
    for got, want in ((succ, want_s), (fail, want_f)):
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_checkpoint_folder_comes_from_the_session(spark):
    from adlens.session import ensure_checkpoint_dir
    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
