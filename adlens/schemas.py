"""Explicit schemas of the inputs and outputs (no inference pass over logs)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# S1: exposure log (JSON lines, one file per month). Day and month stay text:
# "local-day" is zero-padded and compared as text.
EXPOSURE_LOG = _struct(
    ("dealid", S), ("order_id", S), ("main_order_id", S), ("media_channel_id", S),
    ("tag_id", S), ("adx_material_id", S), ("dsp_id", S), ("advertiser_id", S),
    ("local-month", S), ("local-day", S),
    ("video_id", S), ("adseat_id", S), ("drama_id", S), ("os", S), ("class_id", S),
    ("vis_id", S), ("pkg_id", S), ("act_id", S), ("ad_id", S), ("sltcustomtopic", S),
)

IMP = T.ArrayType(_struct(("tagid", S)))
OPTIONS = _struct(("body", _struct(("imp", IMP))))

# S2: bid-request log.
REQUEST_LOG = _struct(
    ("local-month", S), ("local-day", S), ("isHaveAd", I), ("isReturn", I), ("isTimeOut", I),
    ("media_channel_id", S), ("DSPName", S), ("FinalAdobj", _struct(("dealid", S))),
    ("RedisadInfo", S), ("options", OPTIONS),
)

# S7: the 17 string fields of a structured log record (all nullable text;
# numbers in the JSON arrive as their text).
STREAM_RECORD = _struct(*[(n, S) for n in (
    "dealid", "order_id", "main_order_id", "media_channel_id", "video_id", "adseat_id",
    "drama_id", "os", "class_id", "vis_id", "pkg_id", "act_id", "ad_id", "tag_id",
    "adx_material_id", "dsp_id", "advertiser_id")])

# Dimension and state tables (S3 - S6, S8, S9).
SSP_TAG = _struct(("channel_id", S), ("media_id", S))
ADX_ORDER_DEALID = _struct(("dealid", S), ("order_id", S), ("main_order_id", S), ("is_compensate", I))
STORED_TOTALS = _struct(("dealid", S), ("now_time", S), ("total", I))
DEAL_CAPS = _struct(("dealid", S), ("now_time", S), ("dealidnum", I), ("stop", I))
USABLE_MEDIA = _struct(("video_id", S))
AD_SEAT = _struct(*[(n, S) for n in (
    "video_id", "media_name", "ad_seat_b_time", "ad_seat_e_time", "drama_name", "drama_type_name",
    "media_area_name", "media_release_date", "class2_name", "class_type_id", "class3_name",
    "ad_seat_img")])

# Raw log records replayed from files: the record text and its event time.
RAW_RECORD = _struct(("value", S), ("ts", T.TimestampType()))
