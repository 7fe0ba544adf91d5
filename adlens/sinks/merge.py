"""Keyed table updates as DataFrame operators (K-1 a, K-2).

``upsert`` replaces the measures of existing keys and inserts new keys, keeping
the attributes of existing rows; ``counter_add`` adds deltas to counters. Both
are one full outer join on the keys: a sort-merge join, so neither side is
ever held whole in one task, and AQE splits skewed partitions. Keys match null-safely:
a null key is a key like any other, so a second run updates its row instead of adding one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.session import read_or_none


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: list[str], what: str = "updates") -> None:
    """Raise if a key occurs twice (one distributed aggregate; only a flag returns)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise DuplicateKeyError(f"{what} has duplicate keys on {keys}")


def combine_duplicates(updates: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One row per key: measures summed, other columns their largest value (a fixed
    choice where the reference kept whichever duplicate came last)."""
    others = [c for c in updates.columns if c not in keys and c not in measures]
    aggs = [F.sum(m).alias(m) for m in measures] + [F.max(c).alias(c) for c in others]
    return updates.groupBy(*keys).agg(*aggs).select(*updates.columns)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], measures: list[str],
           check_unique: bool = True, combine: str | None = None) -> DataFrame:
    """New version of ``target`` after INSERT ... ON DUPLICATE KEY UPDATE measures.

    Duplicate keys in ``updates`` raise (D6) unless ``combine="sum"`` asks to
    aggregate them first."""
    if combine == "sum":
        updates, check_unique = combine_duplicates(updates, keys, measures), False
    elif combine is not None:
        raise ValueError(f"unknown combine: {combine}")
    if check_unique:
        assert_unique(updates, keys)
    t = target.select(F.lit(True).alias("_t_hit"), *[F.col(c).alias(f"_t_{c}") for c in target.columns])
    u = updates.select(F.lit(True).alias("_u_hit"), *[F.col(c).alias(f"_u_{c}") for c in updates.columns])
    j = t.join(u, reduce(lambda a, b: a & b, [F.col(f"_t_{k}").eqNullSafe(F.col(f"_u_{k}")) for k in keys]), "full_outer")
    out = []
    for c in [*keys, *[c for c in target.columns if c not in keys]]:
        if c in measures:
            out.append(F.when(F.col("_u_hit"), F.col(f"_u_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in updates.columns:
            # New rows take the attribute from the update, existing rows keep theirs.
            out.append(F.when(F.col("_t_hit"), F.col(f"_t_{c}")).otherwise(F.col(f"_u_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*out)


def counter_add(counters: DataFrame, delta: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """INCRBY for every delta row: counters FULL OUTER JOIN delta, value = a + b."""
    d = delta.groupBy(key).agg(F.sum(value).alias("_d"))  # several deltas per key add up
    c = counters.select(F.col(key).alias("_k"), F.col(value).alias("_c"))
    j = c.join(d, F.col("_k").eqNullSafe(d[key]), "full_outer")
    return j.select(F.coalesce("_k", d[key]).alias(key), (F.coalesce(F.col("_c"), F.lit(0)) + F.coalesce(F.col("_d"), F.lit(0)))
                    .cast("bigint").alias(value))


def stored_schema(spark, path: str, updates: T.StructType) -> T.StructType:
    """Columns of ``updates`` and, after them, those that only the table at ``path`` has. The types
    of ``updates`` hold where both have a column: partition values are not guessed into dates
    or numbers. Days may have been written with different columns: all their footers are merged."""
    known = read_or_none(spark, path, options={"mergeSchema": "true"})
    extra = [f for f in known.schema if f.name not in updates.names] if known is not None else []
    return T.StructType([*updates.fields, *extra])


def merge_partitions(spark, target_path: str, updates: DataFrame, keys: list[str], measures: list[str],
                     partition_col: str, staging_path: str, check_unique: bool = True,
                     combine: str | None = None) -> None:
    """K-1 on a table stored as parquet partitioned by ``partition_col`` (e.g. the day).

    Only the partitions named by ``updates`` are read (a semi join on their values,
    which dynamic partition pruning applies to the scan), merged with ``upsert``,
    written to ``staging_path`` and then swapped into the target with a dynamic
    partition overwrite; other partitions are not touched. The staging step exists
    because Spark does not overwrite a path it reads in the same job. ``updates`` must not
    hold null partition values (the semi join would miss their stored rows).

    The table keeps every stored column: those that ``updates`` lacks stay as they are (null on
    new rows), and columns that only ``updates`` has are added (null on old rows).
    """
    if combine == "sum":
        updates, check_unique = combine_duplicates(updates, keys, measures), False
    # The updates feed the check, the semi join and the merge: they are written once, so
    # whatever made them (a log scan) runs once.
    written = f"{staging_path}-updates"
    updates.write.mode("overwrite").parquet(written)
    updates = spark.read.schema(updates.schema).parquet(written)
    if check_unique:
        assert_unique(updates, keys)
    schema = stored_schema(spark, target_path, updates.schema)
    target = read_or_none(spark, target_path, schema)
    if target is None:
        merged = updates
    else:
        touched = target.join(updates.select(partition_col).distinct(), partition_col, "left_semi")
        merged = upsert(touched, updates, keys, measures, check_unique=False)
    merged.write.mode("overwrite").partitionBy(partition_col).parquet(staging_path)
    (spark.read.schema(schema).parquet(staging_path).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(target_path))
