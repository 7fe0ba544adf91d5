"""Adapters from the driver's TESTDATA tables to reference-shaped inputs.

The reference ships no data, so each input it reads (logs, dimension tables,
the tagged-interval table) is derived from a TESTDATA table by plain column
expressions. Every adapter reads the whole table; its work grows with it.
The same mappings are written as DuckDB SQL in ``adlens.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens import schemas
from adlens.fixed import ADX_TOPIC


_READERS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A TESTDATA table. The tables are read-only, so the reader (schema from the
    footer, file listing) is built once per session and path, like a catalog table;
    no data is cached."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    if key not in _READERS or _READERS[key].sparkSession is not spark:
        _READERS[key] = spark.read.parquet(path)
    return _READERS[key]


def _s(c) -> F.Column:
    return c.cast("string")


def _month_day(ts):
    month = _s(F.year(ts) * 100 + F.month(ts))
    day = F.lpad(_s(F.dayofmonth(ts)), 2, "0")
    return month, day


def exposure_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 from ``events`` (views only); tie-break column ``event_id``."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    u, e = F.col("user_id"), F.col("event_id")
    month, day = _month_day(F.col("ts"))
    return ev.select(
        e.alias("event_id"),
        _s(u).alias("dealid"),
        month.alias("local-month"), day.alias("local-day"),
        F.concat(F.lit("o"), _s(u % 50)).alias("order_id"),
        F.when(u % 7 == 0, F.lit(None).cast("string"))
         .when(u % 3 == 0, F.concat(F.lit("o"), _s(u % 50)))
         .otherwise(F.concat(F.lit("m"), _s(u % 50))).alias("main_order_id"),
        _s(u % 30).alias("media_channel_id"),
        F.when(e % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(_s(u % 30), F.lit("_scene_"), F.col("event_type"))).alias("tag_id"),
        F.concat(F.lit("mat"), _s(e % 40)).alias("adx_material_id"),
        _s(F.lit(10001) + u % 4).alias("dsp_id"),
        F.concat(F.lit("adv"), _s(u % 9)).alias("advertiser_id"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 from ``events`` with the nested ``FinalAdobj`` / ``options`` columns."""
    ev = table(spark, sf_dir, "events")
    u, e, et = F.col("user_id"), F.col("event_id"), F.col("event_type")
    month, day = _month_day(F.col("ts"))
    redis = F.concat(
        F.lit('{"tag_id":"Scene_'), _s(u % 30), F.lit("_"), et,
        F.lit('","adx_material_id":"mat'), _s(e % 40),
        F.lit('","dsp_id":'), _s(F.lit(10001) + u % 4),
        F.lit(',"advertiser_id":"adv'), _s(u % 9), F.lit('"}'))
    options_json = (F.when(e % 17 == 0, F.lit('{"body":{"imp":[]}}'))
                    .otherwise(F.concat(F.lit('{"body":{"imp":[{"tagid":"'), _s(u % 30),
                                        F.lit("_scene_"), et, F.lit('"}]}}'))))
    return ev.select(
        e.alias("event_id"),
        month.alias("local-month"), day.alias("local-day"),
        F.when(et.isin("click", "purchase"), 1).otherwise(0).cast("int").alias("isHaveAd"),
        F.when(et == "error", 1).when(et == "signup", 0).cast("int").alias("isReturn"),
        F.when((et == "signup") & (F.col("value") < 10), 1).when(et == "signup", 0)
         .cast("int").alias("isTimeOut"),
        _s(u % 30).alias("media_channel_id"),
        F.concat(F.lit("DSP_"), _s(F.lit(10001) + u % 4)).alias("DSPName"),
        F.struct(_s(u).alias("dealid")).alias("FinalAdobj"),
        redis.alias("RedisadInfo"),
        F.from_json(options_json, schemas.OPTIONS).alias("options"),
        F.col("ts"),
    )


def ssp_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 from ``nation``, shifted by 8: channels 0-7 have no row (default "000" applies)."""
    return table(spark, sf_dir, "nation").select(
        _s(F.col("n_nationkey") + 8).alias("channel_id"), F.col("n_name").alias("media_id"))


def adx_order_dealid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 from ``customer``; every 4th order belongs to a deal that no log names (``-id``)."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _s(F.when(c % 4 == 0, -c).otherwise(c)).alias("dealid"),
        F.concat(F.lit("o"), _s(c % 50)).alias("order_id"),
        F.concat(F.lit("m"), _s(c % 20)).alias("main_order_id"),
        (c % 2).cast("int").alias("is_compensate"))


def deal_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 cap table from ``events``: one row per (deal, day)."""
    u = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        _s(u).alias("dealid"), _s(F.to_date("ts")).alias("now_time"),
        (F.lit(31) + u % 4).cast("int").alias("dealidnum"), F.lit(0).cast("int").alias("stop"),
    ).distinct()


def stored_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 state before the batch: click counts per deal and day. Even users' counts are stored
    under deals that no record names (``-id``), so they meet no batch row."""
    u = F.col("user_id")
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    return (ev.groupBy(F.when(u % 2 == 0, -u).otherwise(u).alias("u"), F.to_date("ts").alias("d"))
            .agg(F.count(F.lit(1)).cast("int").alias("total"))
            .select(_s(F.col("u")).alias("dealid"), _s(F.col("d")).alias("now_time"), "total"))


def raw_stream_value(event_id, user_id, event_type) -> F.Column:
    """S7 record text, with malformed, deal-less and topic-less records mixed in."""
    e, u, et = event_id, user_id, event_type
    return (F.when(e % 23 == 0, F.concat(F.lit("{bad "), et))
            .when(e % 29 == 0, F.concat(F.lit('{"dealid":"'), _s(u), F.lit('"}')))
            .when(e % 31 == 0, F.lit('{"sltcustomtopic":"' + ADX_TOPIC + '"}'))
            .otherwise(F.concat(
                F.lit('{"dealid":"'), _s(u), F.lit('","dsp_id":10001,"sltcustomtopic":"'),
                F.when(et.isin("view", "click"), F.lit(ADX_TOPIC)).otherwise(F.lit("other")),
                F.lit('"}'))))


def to_raw_stream(events: DataFrame) -> DataFrame:
    """Works on a batch or a streaming ``events`` frame."""
    return events.select(
        F.col("event_id"), F.col("ts"),
        raw_stream_value(F.col("event_id"), F.col("user_id"), F.col("event_type")).alias("value"))


def to_log_records(events: DataFrame) -> DataFrame:
    """``events`` as keyed log records: the key is the deal, the timestamp the event's."""
    return events.select("event_id", _s(F.col("user_id")).alias("key"), F.col("ts").cast("timestamp").alias("timestamp"),
                         raw_stream_value(F.col("event_id"), F.col("user_id"), F.col("event_type")).alias("value"))


def raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw_stream(table(spark, sf_dir, "events"))


def usable_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 from ``part``."""
    return (table(spark, sf_dir, "part").filter(F.col("p_size") > 25)
            .select(_s(F.col("p_partkey")).alias("video_id")))


# Columns of lineitem that together order the intervals of one video; rows equal
# in all of them are interchangeable in every output.
LINEITEM_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def ad_seat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 tagged intervals from ``lineitem`` joined with ``part``.

    Times are ms as text, like the reference's JDBC table. Some orders' intervals have a begin
    or an end that is no number, or end long before they begin. ``sid`` is the
    tie-break of intervals inside a video: a struct of the lineitem columns.
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    sd = F.col("l_shipdate")
    base_ms = ((F.year(sd) - 1992) * 372 + F.month(sd) * 31 + F.dayofmonth(sd)).cast("bigint") * 1000
    order = F.col("l_orderkey")
    length_ms = F.when(order % 89 == 0, F.lit(-20)).otherwise(F.col("l_quantity").cast("bigint")) * 1000
    return li.join(part, li.l_partkey == part.p_partkey).select(
        _s(F.col("l_partkey")).alias("video_id"),
        F.col("p_name").alias("media_name"),
        F.when(order % 97 == 0, F.lit("n/a")).otherwise(_s(base_ms)).alias("ad_seat_b_time"),
        F.when(order % 101 == 0, F.lit("")).otherwise(_s(base_ms + length_ms)).alias("ad_seat_e_time"),
        F.col("p_brand").alias("drama_name"),
        F.col("p_type").alias("drama_type_name"),
        F.lit("area").alias("media_area_name"),
        _s(F.year(sd)).alias("media_release_date"),
        F.col("l_returnflag").alias("class2_name"),
        _s(F.col("l_linenumber")).alias("class_type_id"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("class3_name"),
        F.concat(F.lit("img"), _s(F.col("l_suppkey"))).alias("ad_seat_img"),
        F.struct(*[F.col(c) for c in LINEITEM_ORDER]).alias("sid"),
    )
