"""rank_within and explode_range against plain Spark equivalents, with one hot group."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.operators.ordering import explode_range, prefix_within, rank_within, scans_within


@pytest.mark.parametrize("hot_rows", [0, None])  # 0 forces the range-partitioned path
def test_rank_within_equals_row_number_on_skewed_groups(spark, hot_rows):
    # group "hot" holds most rows; a null group is ranked too
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 == 9, F.lit(None))
         .otherwise(F.concat(F.lit("g"), (F.col("id") % 13).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 1000).alias("k"), F.col("id"))
    got = rank_within(df, ["g"], ["k", "id"], out="rn", partitions=16, hot_rows=hot_rows)
    w = Window.partitionBy("g").orderBy("k", "id")
    want = df.withColumn("rn", F.row_number().over(w))
    assert got.count() == 20000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_explode_range_matches_sequence(spark):
    df = spark.createDataFrame([(1, 1, 10), (2, 5, 4), (3, 0, 9000), (4, 7, 7)], "id int, lo long, hi long")
    got = explode_range(df, F.col("lo"), F.col("hi"), "x", chunk=16, spread=["id"])
    want = df.filter("lo <= hi").select("id", "lo", "hi", F.explode(F.sequence("lo", "hi")).alias("x"))
    assert got.count() == 10 + 9001 + 1
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("how,inclusive", [("max", False), ("max", True), ("sum", True), ("min", False)])
def test_prefix_within_range_path_equals_window(spark, how, inclusive):
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
        F.col("id"), ((F.col("id") * 7919) % 997).alias("v"))
    forced = prefix_within(df, ["g"], ["id"], "v", how, out="p", inclusive=inclusive, partitions=8, hot_rows=0)
    plain = prefix_within(df, ["g"], ["id"], "v", how, out="p", inclusive=inclusive)
    assert forced.exceptAll(plain).count() == 0 and plain.exceptAll(forced).count() == 0


def test_previous_values_range_path_equal_lag(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 5 < 4, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
        F.col("id"), ((F.col("id") * 31) % 101).alias("v"))
    forced = rank_within(df, ["g"], ["id"], out="rn", hot_rows=0, previous={"v": "pv"})
    plain = rank_within(df, ["g"], ["id"], out="rn", previous={"v": "pv"})
    assert forced.exceptAll(plain).count() == 0 and plain.exceptAll(forced).count() == 0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-5, 5)), min_size=1, max_size=40,
                     unique_by=lambda r: r),
       parts=st.integers(1, 6))
def test_range_path_scans_equal_python(spark, rows, parts):
    df = spark.createDataFrame(rows, "g string, k long")
    ranked = rank_within(df, ["g"], ["k"], out="rn", partitions=parts, hot_rows=0, previous={"k": "pk"})
    running = prefix_within(df, ["g"], ["k"], "k", "sum", out="s", inclusive=True, partitions=parts, hot_rows=0)
    want_rank, want_sum = {}, {}
    for g in {r[0] for r in rows}:
        ks = sorted(k for gg, k in rows if gg == g)
        for i, k in enumerate(ks):
            want_rank[(g, k)] = (i + 1, ks[i - 1] if i else None)
            want_sum[(g, k)] = sum(ks[: i + 1])
    assert {(r["g"], r["k"]): (r["rn"], r["pk"]) for r in ranked.collect()} == want_rank
    assert {(r["g"], r["k"]): r["s"] for r in running.collect()} == want_sum


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from(["a", None]), st.integers(0, 30), st.one_of(st.none(), st.integers(-9, 9))),
                     min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1])),
       how=st.sampled_from(["max", "sum", "min"]), inclusive=st.booleans())
def test_prefix_scans_with_null_values_equal_window(spark, rows, how, inclusive):
    df = spark.createDataFrame(rows, "g string, k long, v long")
    forced = prefix_within(df, ["g"], ["k"], "v", how, out="p", inclusive=inclusive, partitions=3, hot_rows=0)
    plain = prefix_within(df, ["g"], ["k"], "v", how, out="p", inclusive=inclusive)
    assert sorted(map(tuple, forced.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


@settings(max_examples=6, deadline=None)
@given(ranges=st.lists(st.tuples(st.integers(-20, 20), st.integers(0, 300)), min_size=1, max_size=6),
       chunk=st.integers(1, 50), spread=st.booleans())
def test_explode_range_equals_python(spark, ranges, chunk, spread):
    rows = [(i, lo, lo + n - 1) for i, (lo, n) in enumerate(ranges)]
    df = spark.createDataFrame(rows, "id long, lo long, hi long")
    got = explode_range(df, F.col("lo"), F.col("hi"), "x", chunk=chunk, spread=["id"] if spread else None)
    assert sorted((r["id"], r["x"]) for r in got.collect()) == sorted((i, x) for i, lo, hi in rows
                                                                      for x in range(lo, hi + 1))


@pytest.mark.parametrize("inclusive", [False, True])
def test_scans_over_cut_groups_equal_windows(spark, inclusive):
    """Groups cut into many slices, a null group, null values, marks several slices away."""
    df = spark.range(600).select(
        F.when(F.col("id") < 400, "big").when(F.col("id") < 500, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"),
        F.xxhash64("id").alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 17).alias("v"),
        F.when(F.col("id") % 150 == 7, F.struct(F.col("id").alias("a"), F.lit(None).cast("string").alias("b"))).alias("mark"))

    def scans(hot):
        out = scans_within(df, ["g"], ["k"], rank="rn", previous={"v": "pv"}, running={"s": ("v", "sum"), "m": ("v", "max"), "l": ("v", "min")},
                           following={"next": "mark"}, inclusive=inclusive, partitions=13, hot=hot)
        return sorted(map(str, out.collect()))

    got = scans(True)
    assert got == scans(False) and len(got) == 600
