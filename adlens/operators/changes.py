"""Tag lists as change lists (V-4) of bounded size.

The list form of a segment names every interval active in it, so a video where k intervals
overlap throughout costs k rows per segment. But neighbouring segments differ by the one
interval that begins or ends between them. Here a video is kept as

* one ``added`` or ``removed`` row per point: what changes from segment p - 1 to segment p;
* ``full`` rows, the whole active set, at every M-th point, M being the larger of ``every`` and the
  most intervals ever active in the video.

A full list has at most M rows and stands M points from the next, so a video costs at most
two rows per point whatever overlaps, and any segment is read from one full list and at
most M changes. Everything is joins and aggregates on (video, point); a hot video is spread
as in the sweep itself.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.fixed import CLASS_LISTS
from adlens.operators import segments as vs
from adlens.operators.ordering import checkpointed, explode_range, longest_range, prefix_within

ITEM = ["pb", "cls", "c3", "c2", "img"]


def _items(spans: DataFrame) -> DataFrame:
    """Intervals with the fields that lists are made of; ``pb`` orders and identifies them."""
    return spans.select("video_id", "pb", "pe", F.col("class_type_id").cast("string").alias("cls"), F.col("class3_name").alias("c3"),
                        F.col("class2_name").alias("c2"), F.col("ad_seat_img").alias("img"))


def change_lists(iv: DataFrame, numbered_points: DataFrame, every: int = 1024, hot: bool | None = None) -> DataFrame:
    """(video_id, every, p, kind, pb, cls, c3, c2, img): the change lists of all segments.

    ``kind`` is ``added`` / ``removed`` (in segment p, unlike p - 1) or ``full`` (active in segment
    p, a multiple of the video's ``every``).
    """
    spans = checkpointed(_items(vs._spans(iv, numbered_points)))
    step = F.when(F.col("is_end") == 0, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    active = prefix_within(numbered_points.select("video_id", "p", "is_end"), ["video_id"], ["p"], step, "sum", out="n_active", hot=hot)
    # The number of active intervals before a point; after the last one none is active.
    spacing = active.groupBy("video_id").agg(F.greatest(F.max("n_active"), F.lit(every)).cast("long").alias("every"))
    rows = checkpointed(spans.join(spacing, "video_id"))
    added = rows.select("video_id", "every", (F.col("pb") + 1).alias("p"), F.lit("added").alias("kind"), *ITEM)
    removed = rows.select("video_id", "every", (F.col("pe") + 1).alias("p"), F.lit("removed").alias("kind"), *ITEM)
    first, last = F.floor(F.col("pb") / F.col("every")).cast("long") + 1, F.floor(F.col("pe") / F.col("every")).cast("long")
    spread = ["video_id"] if longest_range(rows, first, last) > vs.SPREAD_ABOVE else None
    full = explode_range(rows, first, last, "_i", spread=spread)
    full = full.select("video_id", "every", (F.col("_i") * F.col("every")).alias("p"), F.lit("full").alias("kind"), *ITEM)
    return added.unionByName(removed).unionByName(full)


def change_lists_of(seats: DataFrame, usable: DataFrame, every: int = 1024, hot: bool | None = None) -> DataFrame:
    """:func:`change_lists` of the usable, padded, valid intervals."""
    iv = checkpointed(vs.interval_rank(vs.prepare_intervals(seats, usable), hot=hot))
    return change_lists(iv, checkpointed(vs.points(iv, hot=hot)), every, hot)


LISTS = [(cls, field, f"string_{name}{suffix}") for cls, name in CLASS_LISTS
         for suffix, field in (("_list", 2), ("2_list", 3), ("_img_list", 4))]


def expand(changes: DataFrame) -> DataFrame:
    """(video_id, p, the twelve lists) of every segment with an active interval, from change lists.

    A block is one full list and the changes up to the next. Blocks are dealt over tasks and
    sorted, and a task replays one after the other, holding one block: at most M rows of
    each kind.
    """
    columns = "video_id string, p long, " + ", ".join(f"{out} array<string>" for *_, out in LISTS)

    def replay(video: str, start: int, m: int, state: list[tuple], steps: dict[int, tuple]) -> Iterator[tuple]:
        for p in range(start, start + m):
            if p in steps and p > start:  # what leads to the block's first segment is in its full list
                kind, item = steps[p]
                if kind == "added":
                    insort(state, item, key=lambda x: x[0])
                else:
                    state = [x for x in state if x[0] != item[0]]
            if state:
                yield (video, p, *[[x[f] for x in state if x[1] == cls] for cls, f, _ in LISTS])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["video_id", "p", *[o for *_, o in LISTS]]
        held, state, steps = None, [], {}
        for batch in batches:
            out = []
            for video, block, m, p, kind, *item in zip(*[batch[c].tolist() for c in ("video_id", "block", "every", "p", "kind", *ITEM)]):
                if held != (video, block * m, m):
                    if held:
                        out += replay(*held, state, steps)
                    held, state, steps = (video, block * m, m), [], {}
                if kind == "full":
                    state.append(tuple(item))  # in the order of pb
                else:
                    steps[p] = (kind, tuple(item))
            yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame(list(replay(*held, state, steps)), columns=names)

    blocks = changes.withColumn("block", F.floor(F.col("p") / F.col("every")).cast("long"))
    n = int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(n, "video_id", "block").sortWithinPartitions("video_id", "block", "pb")
    return dealt.select("video_id", "block", "every", "p", "kind", *ITEM).mapInPandas(run, columns)
