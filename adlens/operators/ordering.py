"""Order-dependent building blocks that stay parallel inside one hot group.

Both scans first measure the largest group (one count aggregate). Without a hot
group they are plain window functions; with one they use the plan below.

``rank_within`` is ``row_number() OVER (PARTITION BY g ORDER BY o)`` without a
per-group window: rows are range-partitioned on (g, o), so a group holding a
third of the data is spread over many tasks. Each task numbers its rows; a
small table of per-(task, group) counts gives the offset of every task's slice
of a group. Its size is bounded by #groups + #partitions, and its only window
is over the (at most #partitions) slices of one group. The numbered rows are
checkpointed once (``spark.checkpoint.dir``), so both reads see one placement.

``scans_within`` gives positions, previous values, running totals and next marks from one
such placement, without a join of rows: only slices of cut groups are carried over.

``explode_range`` turns [lo, hi] into one row per integer in two steps, with a
repartition between, so one long range is neither materialised as one array
nor generated by a single task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.session import ensure_checkpoint_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint into the session's checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# A group up to this many rows is ranked / scanned by one window task (sorted,
# spilling if needed). Larger groups take the range-partitioned path.
HOT_GROUP_ROWS = 5_000_000


def _partitions(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def largest_group(df: DataFrame, group: list[str]) -> int:
    """Row count of the largest group: a partial + final count, one row to the driver."""
    v = df.groupBy(*group).count().agg(F.max("count")).first()[0]
    return int(v or 0)


def is_hot(largest: int, hot_rows: int | None = None) -> bool:
    limit = HOT_GROUP_ROWS if hot_rows is None else hot_rows
    return limit <= 0 or largest > limit


def _has_hot_group(df: DataFrame, group: list[str], hot_rows: int | None) -> bool:
    limit = HOT_GROUP_ROWS if hot_rows is None else hot_rows
    return limit <= 0 or largest_group(df, group) > limit


def rank_within(df: DataFrame, group: list[str], order: list[str | Column], out: str = "rn",
                partitions: int | None = None, hot_rows: int | None = None,
                previous: dict[str, str] | None = None, hot: bool | None = None) -> DataFrame:
    """1-based position of each row in its group under ``order`` (ties broken arbitrarily,
    so ``order`` should make rows unique up to interchangeable duplicates).

    ``previous`` maps a column to an output name holding that column's value on the
    previous row of the group (null on the first).

    When no group exceeds ``hot_rows`` (checked by one count aggregate) this is one
    window pass (``row_number`` and ``lag``); otherwise the range-partitioned plan
    below, with previous values from ``scans_within``.
    ``hot`` skips the check when the caller already knows the answer."""
    if hot is None:
        hot = _has_hot_group(df, group, hot_rows)
    if hot and not previous:
        return _rank_by_range(df, group, order, out, partitions)
    return scans_within(df, group, order, rank=out, previous=previous, partitions=partitions, hot=hot)


def _rank_by_range(df: DataFrame, group: list[str], order: list[str | Column], out: str,
                   partitions: int | None) -> DataFrame:
    n = _partitions(df, partitions)
    keys = [F.col(c) if isinstance(c, str) else c for c in (*group, *order)]
    cols = df.columns
    # The numbered rows are read twice (slice counts, join back). Range bounds come
    # from sampling, so two evaluations could place rows differently: checkpoint
    # fixes one placement in the shared checkpoint folder (and survives executor loss).
    tagged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = checkpointed(tagged)
    gnames = [f"_g{i}" for i in range(len(group))]
    slices = (tagged.groupBy("_pid", *group)
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(F.col("_pid").alias("_spid"), *[F.col(g).alias(a) for g, a in zip(group, gnames)],
                           "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    cond = reduce(lambda a, b: a & b,
                  [F.col("_pid") == F.col("_spid")] + [F.col(g).eqNullSafe(F.col(a)) for g, a in zip(group, gnames)])
    joined = tagged.join(slices, cond)
    return joined.select(*cols, (F.col("_before") + F.col("_mid") - F.col("_first") + 1).alias(out))


def explode_range(df: DataFrame, lo: Column, hi: Column, out: str, chunk: int = 4096,
                  spread: list[str] | None = None) -> DataFrame:
    """One row per integer in [lo, hi] (no row when lo > hi), other columns repeated.

    Ranges are first cut into pieces of max(``chunk``, sqrt(length)) values, so
    neither explode materialises more than about sqrt(length) elements of one
    range; with ``spread`` the pieces are repartitioned on ``spread`` + piece start
    before the second explode, so one long range is generated by many tasks.
    """
    cols = df.columns
    size = F.greatest(F.lit(chunk).cast("long"), F.ceil(F.sqrt(F.col("_hi") - F.col("_lo") + 1)).cast("long"))
    pieces = (df.withColumn("_lo", lo).withColumn("_hi", hi).filter(F.col("_lo") <= F.col("_hi"))
              .withColumn("_c", size)
              .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"),
                                                     F.floor((F.col("_hi") - F.col("_lo")) / F.col("_c")).cast("long"))))
              .withColumn("_a", F.col("_lo") + F.col("_k") * F.col("_c"))
              .withColumn("_b", F.least(F.col("_hi"), F.col("_a") + F.col("_c") - 1)))
    if spread is not None:
        pieces = pieces.repartition(*[F.col(c) for c in spread], F.col("_a"))
    return pieces.select(*cols, F.explode(F.sequence(F.col("_a"), F.col("_b"))).alias(out))


def longest_range(df: DataFrame, lo: Column, hi: Column) -> int:
    """Largest ``hi - lo + 1`` (0 if none): one small aggregate, used to decide
    whether ``explode_range`` needs to spread pieces over tasks."""
    v = df.agg(F.max(hi - lo + 1)).first()[0]
    return int(v or 0)


_SCANS = {"max": F.max, "min": F.min, "sum": F.sum}


def prefix_within(df: DataFrame, group: list[str], order: list[str], value: Column | str, how: str = "max",
                  out: str = "prefix", inclusive: bool = False, partitions: int | None = None,
                  hot_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Running ``how`` (max / min / sum) of ``value`` over the rows before (or up to)
    each row of its group, in ``order`` (which must make rows unique).

    Same plan shape as ``rank_within``: range partitions hold contiguous slices
    of a group; a window inside each (partition, group) slice gives the local
    running value, and a small table carries each slice's total forward to the
    later slices of the same group. Null where no row precedes. ``hot`` skips the size
    check when the caller already knows the answer.
    """
    fn = _SCANS[how]
    upto = 0 if inclusive else -1
    v = F.col(value) if isinstance(value, str) else value
    if hot is None:
        hot = _has_hot_group(df, group, hot_rows)
    if not hot:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
        return df.withColumn(out, fn(v).over(w))
    n = _partitions(df, partitions)
    keys = [F.col(c) for c in (*group, *order)]
    cols = df.columns
    tagged = (df.withColumn("_v", v).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id()))
    tagged = checkpointed(tagged)
    local = Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
    scanned = tagged.withColumn("_loc", fn("_v").over(local))
    gnames = [f"_g{i}" for i in range(len(group))]
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = (tagged.groupBy("_pid", *group).agg(fn("_v").alias("_sv"))
              .select(F.col("_pid").alias("_spid"), *[F.col(g).alias(a) for g, a in zip(group, gnames)],
                      fn("_sv").over(earlier).alias("_carry")))
    cond = reduce(lambda a, b: a & b,
                  [F.col("_pid") == F.col("_spid")] + [F.col(g).eqNullSafe(F.col(a)) for g, a in zip(group, gnames)])
    joined = scanned.join(slices, cond)
    return joined.select(*cols, _combined(how, F.col("_loc"), F.col("_carry")).alias(out))


def scans_within(df: DataFrame, group: list[str], order: list[str | Column], rank: str | None = None,
                 previous: dict[str, str] | None = None, running: dict[str, tuple[Column | str, str]] | None = None,
                 following: dict[str, Column | str] | None = None, inclusive: bool = False,
                 partitions: int | None = None, hot: bool = False) -> DataFrame:
    """Several scans over the rows of each group in one ``order`` (which must make rows
    unique, up to interchangeable duplicates), from one placement of the rows:

    * ``rank``: name of the 1-based position;
    * ``previous``: column -> name of its value on the previous row (null on the first);
    * ``running``: name -> (value, max / min / sum) over the rows before (``inclusive``: up to) each row;
    * ``following``: name -> value of the first row, from each one on, where it is not null.

    Without a ``hot`` group these are window functions. With one, range partitions hold
    contiguous slices of a group, checkpointed once; windows inside each (partition, group)
    slice give the local values. Only groups cut by a partition bound need more, and there
    are fewer of them than partitions: a table of their slices (at most two rows per
    partition), broadcast, carries every slice's totals to the others of its group.
    """
    previous, running, following = previous or {}, running or {}, following or {}
    cols = df.columns
    values = {f"_v{i}": (F.col(v) if isinstance(v, str) else v) for i, (v, _) in enumerate(running.values())}
    values |= {f"_f{i}": (F.col(v) if isinstance(v, str) else v) for i, v in enumerate(following.values())}
    hows = [_SCANS[how] for _, how in running.values()]
    rows = df.withColumns(values) if values else df
    if hot:
        keys = [F.col(c) if isinstance(c, str) else c for c in (*group, *order)]
        rows = checkpointed(rows.repartitionByRange(_partitions(df, partitions), *keys).sortWithinPartitions(*keys)
                            .withColumn("_pid", F.spark_partition_id())
                            .withColumn("_mid", F.monotonically_increasing_id()))
        part, at = ["_pid", *group], [F.col("_mid")]
    else:
        part, at = group, [F.col(c) if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*part).orderBy(*at)
    upto = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    onward = Window.partitionBy(*part).orderBy(*[c.desc() for c in at]).rowsBetween(Window.unboundedPreceding, 0)
    local = {"_r": F.row_number().over(w).cast("bigint")} if rank or (hot and previous) else {}
    local |= {f"_p{i}": F.lag(c).over(w) for i, c in enumerate(previous)}
    local |= {f"_s{i}": fn(F.col(f"_v{i}")).over(upto) for i, fn in enumerate(hows)}
    scanned = rows.withColumns(local) if local else rows
    # the other direction last: one sort for all of the above, one for this
    ahead = {f"_n{i}": F.last(f"_f{i}", ignorenulls=True).over(onward) for i in range(len(following))}
    scanned = scanned.withColumns(ahead) if ahead else scanned
    got = {f"_{k}": F.col(f"_{k}") for k in ([f"p{i}" for i in range(len(previous))] + [f"s{i}" for i in range(len(running))]
                                             + [f"n{i}" for i in range(len(following))])}
    position = F.col("_r")
    if hot:
        carries, cond = _carries(rows, group, list(previous), hows, len(following))
        scanned = scanned.join(F.broadcast(carries), cond, "left")
        position = F.col("_r") + F.coalesce("_before", F.lit(0))
        for i in range(len(previous)):
            got[f"_p{i}"] = F.when(F.col("_r") == 1, F.col(f"_cp{i}")).otherwise(F.col(f"_p{i}"))
        for i, (_, how) in enumerate(running.values()):
            got[f"_s{i}"] = _combined(how, F.col(f"_s{i}"), F.col(f"_cs{i}"))
        for i in range(len(following)):
            got[f"_n{i}"] = F.coalesce(f"_n{i}", f"_cn{i}")
    outs = ([rank] if rank else []) + [*previous.values(), *running, *following]
    found = ([position] if rank else []) + list(got.values())
    return scanned.select(*cols, *[c.alias(name) for c, name in zip(found, outs)])


def _carries(rows: DataFrame, group: list[str], previous: list[str], hows: list, n_following: int) -> tuple[DataFrame, Column]:
    """Per slice of a group that a partition bound cuts: what the group's other slices
    bring to it; and the condition that joins it to the slice's rows."""
    gnames = [f"_g{i}" for i in range(len(group))]
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(a)) for g, a in zip(group, gnames)])
    cut = (rows.groupBy(*group).agg(F.min("_pid").alias("_lo"), F.max("_pid").alias("_hi")).filter("_lo < _hi")
           .select(*[F.col(g).alias(a) for g, a in zip(group, gnames)]))
    totals = [F.count(F.lit(1)).alias("_tn")]
    totals += [F.max_by(F.struct(F.col(c).alias("v")), F.col("_mid")).alias(f"_tp{i}") for i, c in enumerate(previous)]
    totals += [fn(f"_v{i}").alias(f"_ts{i}") for i, fn in enumerate(hows)]
    totals += [F.min_by(F.col(f"_f{i}"), F.when(F.col(f"_f{i}").isNotNull(), F.col("_mid"))).alias(f"_tf{i}") for i in range(n_following)]
    slices = rows.join(F.broadcast(cut), same).groupBy("_pid", *gnames).agg(*totals)
    w = Window.partitionBy(*gnames).orderBy("_pid")
    earlier, later = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    carried = [F.sum("_tn").over(earlier).alias("_before")]
    carried += [F.lag(f"_tp{i}").over(w).getField("v").alias(f"_cp{i}") for i in range(len(previous))]
    carried += [fn(f"_ts{i}").over(earlier).alias(f"_cs{i}") for i, fn in enumerate(hows)]
    carried += [F.first(f"_tf{i}", ignorenulls=True).over(later).alias(f"_cn{i}") for i in range(n_following)]
    return (slices.select(F.col("_pid").alias("_spid"), *gnames, *carried), (F.col("_pid") == F.col("_spid")) & same)


def _combined(how: str, local: Column, carry: Column) -> Column:
    if how == "sum":
        return F.when(local.isNull() & carry.isNull(), F.lit(None)).otherwise(
            F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0)))
    return F.greatest(local, carry) if how == "max" else F.least(local, carry)  # both skip nulls
