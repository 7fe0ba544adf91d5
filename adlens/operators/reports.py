"""Batch reports R-1 ... R-7: per-deal / per-DSP counts enriched from dimensions.

Each report is one partial + final aggregate (map-side combine, so a hot deal
is pre-aggregated in every task before the shuffle) followed by lookups against
small dimension tables. ``first(x)`` of the reference is made deterministic as
one ``min_by(struct(attributes), ord)``: all attributes of the row with the
smallest tie-break, nulls included. Its text buffer makes the aggregate
sort-based (as ``first`` of text was in the reference); one struct keeps it to
one comparison per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.scalar import (compact_day, dashed_day, differs_flag, first_element,
                                     json_field, last_part, null_safe_sum, row_count)
from adlens.fixed import MISSING_MEDIA
from adlens.operators.lookup import left_lookup
from adlens.operators.ordering import checkpointed

MONTH, DAY = "local-month", "local-day"


@dataclass(frozen=True)
class RunDay:
    """A report day as the reference derives it: ``yyyyMMdd`` -> month path + day filter."""
    yyyymmdd: str

    @property
    def month(self) -> str:
        return self.yyyymmdd[:6]

    @property
    def day(self) -> str:
        return self.yyyymmdd[6:8]

    @classmethod
    def parse(cls, text: str) -> "RunDay":
        return cls(text.replace("-", ""))


def _one_day(log: DataFrame, run: RunDay) -> DataFrame:
    # Month equality stands for the reference's month file; day is the P-2 filter.
    return log.filter((F.col(MONTH) == run.month) & (F.col(DAY) == run.day))


def _months(log: DataFrame, months) -> DataFrame:
    return log if not months else log.filter(F.col(MONTH).isin(list(months)))


# ---------------------------------------------------------------- exposure (R-1, R-2)

_EXPOSURE_ATTRS = ("order_id", "main_order_id", "media_channel_id", "tag_id", "adx_material_id",
                   "dsp_id", "advertiser_id")


def _first_row(cols, ord_col: str):
    """All ``first`` attributes in one ``min_by`` over a struct: one comparison per row,
    and every attribute from the same row."""
    return F.min_by(F.struct(*[F.col(c).alias(c.replace("-", "_")) for c in cols]), F.col(ord_col)).alias("_first")


def _exposure_measures(ord_col: str, extra=()):
    return [_first_row((*_EXPOSURE_ATTRS, *extra), ord_col), row_count().alias("total")]


def _unpack(df: DataFrame) -> DataFrame:
    fields = df.schema["_first"].dataType.fieldNames()
    return df.select(*[c for c in df.columns if c != "_first"],
                     *[F.col("_first").getField(f).alias(f) for f in fields])


def _exposure_finish(agg: DataFrame, ssp_tag: DataFrame) -> DataFrame:
    shaped = agg.select(
        "dealid", "daytime", "order_id", "main_order_id",
        differs_flag("order_id", "main_order_id").alias("is_compensate"),
        "media_channel_id", "tag_id", last_part("tag_id").alias("tag_id_channel"),
        "adx_material_id", "dsp_id", "advertiser_id", "total")
    joined = left_lookup(shaped, ssp_tag, "media_channel_id", "channel_id",
                         {"media_id": "media_id"}, {"media_id": MISSING_MEDIA})
    return joined.select("dealid", "daytime", "order_id", "main_order_id", "is_compensate", "media_id",
                         "media_channel_id", "tag_id", "tag_id_channel", "adx_material_id", "dsp_id",
                         "advertiser_id", "total")


def exposure_report_all(log: DataFrame, ssp_tag: DataFrame, ord_col: str = "event_id",
                        months=None) -> DataFrame:
    """R-2: exposures per (deal, month, day) over all months (or the given ones)."""
    agg = (_unpack(_months(log, months).groupBy("dealid", MONTH, DAY).agg(*_exposure_measures(ord_col)))
           .withColumn("daytime", dashed_day(MONTH, DAY)))
    return _exposure_finish(agg, ssp_tag)


def exposure_partials(log: DataFrame, by, ord_col: str = "event_id") -> DataFrame:
    """Mergeable parts of R-2 per (deal, month, day) and the columns ``by``: the count, the first
    record's place and its attributes."""
    first = F.struct(F.col(ord_col).alias("at"), F.struct(*[F.col(c) for c in _EXPOSURE_ATTRS]).alias("row"))
    return log.groupBy("dealid", F.col(MONTH).alias("month"), F.col(DAY).alias("day"), *by).agg(
        F.min_by(first, F.col(ord_col)).alias("first"), row_count().alias("total"))


def exposure_from_partials(partials: DataFrame, ssp_tag: DataFrame) -> DataFrame:
    """R-2 from the parts of :func:`exposure_partials`."""
    agg = partials.groupBy("dealid", "month", "day").agg(
        F.min_by(F.col("first.row"), F.col("first.at")).alias("_first"), F.sum("total").cast("long").alias("total"))
    return _exposure_finish(_unpack(agg).withColumn("daytime", dashed_day("month", "day")), ssp_tag)


def exposure_report_daily(log: DataFrame, ssp_tag: DataFrame, run: RunDay,
                          ord_col: str = "event_id") -> DataFrame:
    """R-1: exposures per deal on one day (grouped by deal alone, as the reference)."""
    agg = (_unpack(_one_day(log, run).groupBy("dealid").agg(*_exposure_measures(ord_col, (MONTH, DAY))))
           .withColumn("daytime", dashed_day("local_month", "local_day")))
    return _exposure_finish(agg, ssp_tag)


# ---------------------------------------------------------------- bid success (R-3, R-4)

def _success_measures(ord_col: str, extra=()):
    first = F.min_by(F.struct(F.col("media_channel_id"), F.col("RedisadInfo").alias("_info"),
                              *[F.col(c).alias(c.replace("-", "_")) for c in extra]), F.col(ord_col))
    return [first.alias("_first"), row_count().alias("total")]


def _success_fields(df: DataFrame) -> DataFrame:
    # All JSON attributes come from the same first record.
    return (df.withColumn("tag_id", json_field("_info", "tag_id"))
              .withColumn("tag_id_channel", last_part("tag_id"))
              .withColumn("adx_material_id", json_field("_info", "adx_material_id"))
              .withColumn("dsp_id", json_field("_info", "dsp_id"))
              .withColumn("advertiser_id", json_field("_info", "advertiser_id"))
              .drop("_info"))


def _successes(log: DataFrame) -> DataFrame:
    return log.filter(F.col("isHaveAd") == 1)


def success_report_daily(log: DataFrame, ssp_tag: DataFrame, run: RunDay,
                         ord_col: str = "event_id") -> DataFrame:
    """R-3: bid successes per deal on one day; ``daytime`` is ``yyyyMMdd``."""
    agg = (_unpack(_successes(_one_day(log, run))
                   .groupBy(F.col("FinalAdobj.dealid").alias("dealid"))
                   .agg(*_success_measures(ord_col, (MONTH, DAY))))
           .withColumn("daytime", compact_day("local_month", "local_day")))
    out = left_lookup(_success_fields(agg), ssp_tag, "media_channel_id", "channel_id",
                      {"media_id": "media_id"}, {"media_id": MISSING_MEDIA})
    return out.select("dealid", "daytime", "media_id", "media_channel_id", "tag_id_channel",
                      "adx_material_id", "dsp_id", "advertiser_id", "total")


def success_report_all(log: DataFrame, ssp_tag: DataFrame, orders: DataFrame,
                       ord_col: str = "event_id", months=None) -> DataFrame:
    """R-4: bid successes per (deal, month, day), with channel media and deal order data."""
    agg = (_unpack(_successes(_months(log, months))
                   .groupBy(F.col("FinalAdobj.dealid").alias("dealid"), F.col(MONTH), F.col(DAY))
                   .agg(*_success_measures(ord_col)))
           .withColumn("daytime", dashed_day(MONTH, DAY)))
    out = left_lookup(_success_fields(agg), ssp_tag, "media_channel_id", "channel_id",
                      {"media_id": "media_id"}, {"media_id": MISSING_MEDIA})
    out = left_lookup(out, orders, "dealid", "dealid",
                      {"order_id": "order_id", "main_order_id": "main_order_id",
                       "is_compensate": "is_compensate"})
    return out.select("dealid", "daytime", "order_id", "main_order_id", "is_compensate", "media_id",
                      "media_channel_id", "tag_id", "tag_id_channel", "adx_material_id", "dsp_id",
                      "advertiser_id", "total")


# ---------------------------------------------------------------- bid failure (R-5, R-6)

def _failure_measures(ord_col: str, extra=()):
    tag = first_element(F.col("options.body.imp")).getField("tagid")
    first = F.min_by(F.struct(F.col("media_channel_id"), tag.alias("tag_id"),
                              *[F.col(c).alias(c.replace("-", "_")) for c in extra]), F.col(ord_col))
    return [
        first.alias("_first"),
        null_safe_sum("isReturn").alias("return"),
        null_safe_sum("isTimeOut").alias("timeout"),
        row_count().alias("total"),
    ]


def _failure_finish(agg: DataFrame, ssp_tag: DataFrame) -> DataFrame:
    out = left_lookup(agg.withColumn("tag_id_channel", last_part("tag_id")), ssp_tag,
                      "media_channel_id", "channel_id", {"media_id": "media_id"}, {"media_id": MISSING_MEDIA})
    return out.select("dsp_id", "daytime", "media_id", "media_channel_id", "tag_id", "tag_id_channel",
                      "return", "timeout",
                      (F.col("total") - F.col("return") - F.col("timeout")).alias("else_error"), "total")


def _failures(log: DataFrame) -> DataFrame:
    return log.filter(F.col("isHaveAd") == 0)


def _dsp_id():
    # Grouped by the expression itself, not by an alias that a log column could shadow.
    return last_part("DSPName").alias("dsp_id")


def failure_report_daily(log: DataFrame, ssp_tag: DataFrame, run: RunDay,
                         ord_col: str = "event_id") -> DataFrame:
    """R-5: bid failures per DSP on one day (``yyyyMMdd``), with the R-6 column set."""
    agg = (_unpack(_failures(_one_day(log, run)).groupBy(_dsp_id()).agg(*_failure_measures(ord_col, (MONTH, DAY))))
           .withColumn("daytime", compact_day("local_month", "local_day")))
    return _failure_finish(agg, ssp_tag)


def failure_report_all(log: DataFrame, ssp_tag: DataFrame, ord_col: str = "event_id",
                       months=None) -> DataFrame:
    """R-6: bid failures per (DSP, month, day); ``daytime`` is ``yyyy-MM-dd``."""
    agg = (_unpack(_failures(_months(log, months)).groupBy(_dsp_id(), F.col(MONTH), F.col(DAY))
                   .agg(*_failure_measures(ord_col)))
           .withColumn("daytime", dashed_day(MONTH, DAY)))
    return _failure_finish(agg, ssp_tag)


# ---------------------------------------------------------------- one scan for R-4 + R-6

def request_reports_all(log: DataFrame, ssp_tag: DataFrame, orders: DataFrame, ord_col: str = "event_id",
                        months=None) -> tuple[DataFrame, DataFrame]:
    """R-4 and R-6 of the full run from one pass over the request log.

    Both reports group the same log (successes by deal, failures by DSP), so one
    aggregate keyed by (outcome, deal or DSP, month, day) carries both sets of
    measures. It is a few rows per key and day, checkpointed once, and the two
    reports are cut from it: the log is scanned and shuffled once, not twice.
    Results equal ``success_report_all`` and ``failure_report_all``.
    """
    have = F.col("isHaveAd")
    key = F.when(have == 1, F.col("FinalAdobj.dealid")).when(have == 0, last_part("DSPName"))
    tag = first_element(F.col("options.body.imp")).getField("tagid")
    first = F.min_by(F.struct(F.col("media_channel_id"), F.col("RedisadInfo").alias("_info"), tag.alias("tag_id")),
                     F.col(ord_col))
    agg = (_months(log, months).filter(have.isin(0, 1))
           .groupBy(have.alias("_have"), key.alias("_key"), F.col(MONTH), F.col(DAY))
           .agg(first.alias("_first"), null_safe_sum("isReturn").alias("return"),
                null_safe_sum("isTimeOut").alias("timeout"), row_count().alias("total"))
           .withColumn("daytime", dashed_day(MONTH, DAY)))
    agg = checkpointed(agg)
    succ = (_unpack(agg.filter(F.col("_have") == 1)).withColumnRenamed("_key", "dealid")
            .drop("tag_id", "return", "timeout"))
    succ = left_lookup(_success_fields(succ), ssp_tag, "media_channel_id", "channel_id",
                       {"media_id": "media_id"}, {"media_id": MISSING_MEDIA})
    succ = left_lookup(succ, orders, "dealid", "dealid",
                       {"order_id": "order_id", "main_order_id": "main_order_id", "is_compensate": "is_compensate"})
    succ = succ.select("dealid", "daytime", "order_id", "main_order_id", "is_compensate", "media_id",
                       "media_channel_id", "tag_id", "tag_id_channel", "adx_material_id", "dsp_id",
                       "advertiser_id", "total")
    fail = _unpack(agg.filter(F.col("_have") == 0)).withColumnRenamed("_key", "dsp_id").drop("_info")
    return succ, _failure_finish(fail, ssp_tag)


# ---------------------------------------------------------------- run-all (R-7)

def report_summary(reports: dict[str, DataFrame]) -> DataFrame:
    """Row count and summed ``total`` per report, as one small frame."""
    parts = [df.agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("n_rows"),
                    F.sum("total").cast("bigint").alias("sum_total"))
             for name, df in reports.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
