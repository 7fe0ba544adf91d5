"""Change lists: the same tag lists as the sweep's, in rows bounded by the points."""

import random

import pytest
from pyspark.sql import functions as F

from adlens.operators import changes
from adlens.operators import segments as vs


def seats(spark, rows):
    """(video, begin ms, end ms, class, tag) -> interval table."""
    full = [(v, "n", str(b), str(e), "d", "t", "a", "y", tag + "2", c, tag, f"i{k}", k) for k, (v, b, e, c, tag) in enumerate(rows)]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in vs.SEAT_COLUMNS) + ", sid long")


def usable(spark, rows):
    return spark.createDataFrame([(v,) for v in sorted({r[0] for r in rows})], "video_id string")


def lists(df, video, seg):
    cols = [F.col(video).alias("v"), F.col(seg).alias("p"), *[F.to_json(c).alias(c) for c in vs.LIST_COLUMNS]]
    return sorted(map(tuple, df.select(*cols).collect()))


@pytest.mark.parametrize("every,hot", [(1, None), (3, True), (7, False), (1024, None)])
def test_expanded_lists_equal_the_sweep(spark, every, hot):
    rnd = random.Random(every)
    rows = [(f"v{rnd.randrange(4)}", b := rnd.randrange(0, 200_000), b + rnd.randrange(0, 60_000), str(rnd.randrange(1, 6)), f"t{rnd.randrange(9)}") for _ in range(160)]
    rows += [("one", 10_000, 20_000, "1", "x")]
    s, u = seats(spark, rows), usable(spark, rows)
    got = changes.expand(changes.change_lists_of(s, u, every, hot))
    assert lists(got, "video_id", "p") == lists(vs.segment_videos(s, u), "string_vid", "seg_no")


def test_rows_are_bounded_whatever_overlaps(spark):
    """400 intervals that all overlap: 800 segments with up to 400 active ones make 160,000 pairs, and
    at most two change rows per interval, and one full list per 400 points."""
    rows = [("v", 100_000 - k, 500_000 + k, "1", f"t{k}") for k in range(400)]
    kept = changes.change_lists_of(seats(spark, rows), usable(spark, rows), every=4)
    per = {r["kind"]: r["count"] for r in kept.groupBy("kind").count().collect()}
    assert per["added"] == per["removed"] == 400 and per["full"] <= 800
    assert kept.filter("kind = 'full'").groupBy("p").count().agg(F.max("count")).first()[0] <= 400
    got = changes.expand(kept)
    assert got.count() == 799 and got.agg(F.sum(F.size("string_object_list"))).first()[0] == sum(min(k, 800 - k) for k in range(1, 800))


def test_no_intervals(spark):
    rows = [("v", 5, 6, "1", "t")]
    none = seats(spark, rows).limit(0)
    assert changes.expand(changes.change_lists_of(none, usable(spark, rows))).count() == 0
