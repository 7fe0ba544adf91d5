"""Exposure counting, running day totals and cap checks (A-5, P-4, J-3, J-4, P-6, K-3).

Used by the batch keys and, unchanged, inside ``foreachBatch`` of the stream.
Counts are ``groupBy(...).count()``: partial aggregation in every task, so a
hot deal costs one partial row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.fixed import ADX_TOPIC, CAP_SLACK
from adlens.functions.scalar import flag_doc_id, json_field


def keep_topic(records: DataFrame, topic: str = ADX_TOPIC, value_col: str = "value") -> DataFrame:
    """P-4: records whose JSON ``sltcustomtopic`` equals ``topic``; malformed or
    topic-less records give null there and are dropped."""
    return records.filter(json_field(value_col, "sltcustomtopic") == F.lit(topic))


def with_dealid(records: DataFrame, value_col: str = "value") -> DataFrame:
    return records.withColumn("dealid", json_field(value_col, "dealid"))


def deal_counts(records: DataFrame, value_col: str = "value", extra_keys=()) -> DataFrame:
    """A-5: count per deal id (a null deal id is its own group)."""
    return (with_dealid(records, value_col).groupBy("dealid", *extra_keys)
            .agg(F.count(F.lit(1)).alias("total")))


def day_counts(records: DataFrame, day, value_col: str = "value") -> DataFrame:
    """Counts per (deal, day); ``day`` is a Column (event date) or a ``yyyy-MM-dd`` text
    (the processing date of a micro-batch, as in the reference)."""
    d = F.lit(day) if isinstance(day, str) else day
    return deal_counts(records.withColumn("now_time", d), value_col, extra_keys=("now_time",))


def add_to_totals(batch_counts: DataFrame, stored: DataFrame) -> DataFrame:
    """J-3: batch counts LEFT JOIN stored totals on (deal, day); total = a + IFNULL(b, 0)."""
    s = stored.select("dealid", "now_time", F.col("total").alias("_stored"))
    joined = batch_counts.join(s, ["dealid", "now_time"], "left")
    return joined.select("dealid", "now_time",
                         (F.col("total") + F.coalesce(F.col("_stored"), F.lit(0))).cast("bigint").alias("total"))


def near_cap(totals: DataFrame, caps: DataFrame, slack: int = CAP_SLACK) -> DataFrame:
    """J-4 + P-6: (deal, day) whose total exceeds the cap minus ``slack`` (strict ``>``)."""
    c = caps.select("dealid", "now_time", "dealidnum")
    hit = totals.join(c, ["dealid", "now_time"]).filter(F.col("total") > F.col("dealidnum") - F.lit(slack))
    return hit.select("dealid", "now_time", flag_doc_id("dealid", "now_time").alias("doc_id"))


def apply_stop_flags(caps: DataFrame, flagged: DataFrame) -> DataFrame:
    """K-3: set ``stop = 1`` on the cap rows whose doc id was flagged; ids with no cap
    row are ignored, like a partial update of a missing document."""
    # The doc id is deal id + a fixed-width yyyy-MM-dd day, so matching it equals
    # matching (deal, day): join on those columns. No hint: the flagged side is
    # derived (counting it would recompute it), so AQE sizes the join at run time.
    hits = flagged.select("dealid", "now_time", F.lit(True).alias("_hit")).distinct()
    joined = caps.join(hits, ["dealid", "now_time"], "left")
    return joined.select("dealid", "now_time", "dealidnum",
                         F.when(F.col("_hit").isNotNull(), F.lit(1)).otherwise(F.col("stop"))
                          .cast("int").alias("stop"))
