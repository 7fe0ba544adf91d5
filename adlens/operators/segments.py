"""Video segmentation (R-11, V-1 ... V-7): tagged intervals -> consecutive segments.

The reference sorts the begin/end points of all intervals of a video and sweeps
them in one task, emitting before each point the segment
[previous point, this point] with every interval active at that moment. Here
the same result is computed set-wise:

* intervals are ordered in their video by (padded begin, tie-break); point
  order is (time, interval order, begin before end), the order of the
  reference's stable sort;
* points are numbered per video with ``rank_within`` (one window pass, or the
  range-partitioned plan when a measured video is too large for one task), so an
  interval covers point numbers ``pb < p <= pe``;
* the segment at point ``p`` is [t(p-1), t(p)] and holds the intervals with
  ``pb < p <= pe``. For the tag lists ``explode_range`` emits those (segment, interval)
  pairs, which are exactly the elements of the answer, joined to point times on
  (video, p) and grouped on (video, p);
* without lists (``segment_heads``) no pair is made. Call an interval leading if it ends
  no earlier than every interval before it: its end point then comes after theirs. The first
  interval active at a point, if one is, is the one whose end is the next end of a leading
  interval, that point included; the number of active intervals is a running sum of +1
  (begin), -1 (end). So numbers, times, counts and attributes all come from scans over the
  points in one order (``scans_within``), without a join of points or intervals.

Intervals are ranked in their video once; from then on (video, ``rn``), two plain
columns, is an interval's identity in every shuffle.

When a video is hot (measured), every shuffle is keyed by (video, point) or
(video, interval), so one very long video is spread over all tasks; otherwise
the numbering is one window pass per video.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.fixed import CLASS_LISTS, KEPT_CLASSES, PAD_MS
from adlens.functions.scalar import clamp_low
from adlens.operators.ordering import (checkpointed, explode_range, is_hot, largest_group, longest_range,
                                       prefix_within, rank_within, scans_within)

# P-1: the columns read from the interval table.
SEAT_COLUMNS = ("video_id", "media_name", "ad_seat_b_time", "ad_seat_e_time", "drama_name",
                "drama_type_name", "media_area_name", "media_release_date", "class2_name",
                "class_type_id", "class3_name", "ad_seat_img")

ATTRS = (("video_id", "string_vid"), ("media_name", "media_name"), ("drama_name", "string_drama_name"),
         ("drama_type_name", "string_drama_type_name"), ("media_area_name", "string_media_area_name"),
         ("media_release_date", "string_media_release_date"))

IKEY = ["sid", "copy"]  # what tells intervals of one video apart before they are ranked

# A range longer than this is exploded by many tasks (pieces repartitioned first);
# shorter ones are exploded where they are, saving a shuffle of the intervals.
SPREAD_ABOVE = 65536


def join_usable(seats: DataFrame, usable: DataFrame, tie: str = "sid", distinct: bool = False) -> DataFrame:
    """J-5 + P-1: intervals of usable videos. A video listed k times yields each of
    its intervals k times (``copy`` = 1..k), as the reference's inner join does;
    the list is pre-aggregated to (video, k) so duplicates never meet the big side.
    ``distinct=True`` is the semi-join variant: each interval once."""
    if distinct:
        return (seats.select(*SEAT_COLUMNS, tie).join(usable.select("video_id"), "video_id", "left_semi")
                .withColumn("copy", F.lit(1).cast("long")))
    copies = usable.groupBy("video_id").agg(F.count(F.lit(1)).alias("_copies"))
    j = seats.select(*SEAT_COLUMNS, tie).join(copies, "video_id")
    spread = ["video_id"] if longest_range(copies, F.lit(1), F.col("_copies")) > SPREAD_ABOVE else None
    return explode_range(j, F.lit(1), F.col("_copies"), "copy", spread=spread).drop("_copies")


def pad(intervals: DataFrame, pad_ms: int = PAD_MS) -> DataFrame:
    """P-5 + V-1: keep tag classes 1-4, parse ms times, pad both ends (begin floored at 0).

    Adds ``b``, ``e`` (padded) and ``status``: ``ok``, ``bad_time`` (unparsable)
    or ``inverted`` (padded end before padded begin). Only ``ok`` rows are swept.
    """
    kept = intervals.filter(F.col("class_type_id").cast("string").isin(*KEPT_CLASSES))
    b0 = F.col("ad_seat_b_time").try_cast("bigint")
    e0 = F.col("ad_seat_e_time").try_cast("bigint")
    # greatest() skips nulls, so an unparsable begin is caught on the raw value.
    out = kept.withColumn("b", clamp_low(b0 - pad_ms)).withColumn("e", e0 + pad_ms)
    status = (F.when(b0.isNull() | e0.isNull(), "bad_time")
              .when(F.col("e") < F.col("b"), "inverted").otherwise("ok"))
    return out.withColumn("status", status)


def valid(padded: DataFrame) -> DataFrame:
    return padded.filter(F.col("status") == "ok").drop("status")


def rejected(padded: DataFrame) -> DataFrame:
    return padded.filter(F.col("status") != "ok")


def interval_rank(iv: DataFrame, hot: bool | None = None, leading: str | None = None) -> DataFrame:
    """W-1: rank of each interval in its video by (padded begin, tie-break).
    ``leading``: name of a column that tells whether no earlier interval ends later."""
    order = ["b", *IKEY]
    if leading is None:
        return rank_within(iv, ["video_id"], order, out="rn", hot=hot)
    ranked = scans_within(iv, ["video_id"], order, rank="rn", running={"_m": ("e", "max")}, hot=hot)
    return ranked.withColumn(leading, F.col("_m").isNull() | (F.col("e") >= F.col("_m"))).drop("_m")


def points(iv: DataFrame, hot: bool | None = None, leading: str | None = None) -> DataFrame:
    """V-2 + W-2 + W-3: begin/end points numbered ``p`` per video, with the previous point's time.
    ``hot``: whether some video is too large for one window task (checked if None).
    With the ``leading`` column of ``interval_rank`` also ``n_active``, the intervals active
    up to the point, and ``first``, the attributes of the first of them (any, if there is none)."""
    own = _identity(iv)
    begin = [F.col("b").alias("t"), F.lit(0).alias("is_end")]
    end = [F.col("e").alias("t"), F.lit(1).alias("is_end")]
    if leading is not None:
        attrs = F.struct(*[F.col(c) for c, _ in ATTRS if c != "video_id"])
        begin.append(F.when(F.lit(False), attrs).alias("_lead"))
        end.append(F.when(F.col(leading), attrs).alias("_lead"))
    pts = iv.select("video_id", *own, F.explode(F.array(F.struct(*begin), F.struct(*end))).alias("_pt"))
    pts = pts.select("video_id", *own, "_pt.*")
    order = ["t", *own, "is_end"]
    if leading is None:
        return rank_within(pts, ["video_id"], order, out="p", previous={"t": "t_prev"}, hot=hot)
    step = F.when(F.col("is_end") == 0, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    return scans_within(pts, ["video_id"], order, rank="p", previous={"t": "t_prev"},
                        running={"n_active": (step, "sum")}, following={"first": "_lead"}, hot=hot).drop("_lead")


def _identity(iv: DataFrame) -> list[str]:
    """Columns that identify an interval in its video, in interval order."""
    return ["rn"] if "rn" in iv.columns else ["b", *IKEY]


def _spans(iv: DataFrame, numbered_points: DataFrame) -> DataFrame:
    """Intervals with the numbers ``pb``, ``pe`` of their begin and end points."""
    own = ["video_id", *_identity(iv)]
    return iv.join(numbered_points.groupBy(*own).agg(F.min("p").alias("pb"), F.max("p").alias("pe")), own)


def members(iv: DataFrame, numbered_points: DataFrame, longest: int | None = None) -> DataFrame:
    """(segment, interval) pairs: one row per interval active at each point ``p``,
    with the segment bounds ``t_prev``, ``t``. The long form of the answer.
    ``longest``: an upper bound of any span's length (measured if None)."""
    withspan = _spans(iv, numbered_points)
    if longest is None:
        longest = longest_range(withspan, F.col("pb") + 1, F.col("pe"))
    spread = ["video_id"] if longest > SPREAD_ABOVE else None
    pairs = explode_range(withspan, F.col("pb") + 1, F.col("pe"), "p", spread=spread)
    bounds = numbered_points.select("video_id", "p", "t_prev", "t")
    return pairs.join(bounds, ["video_id", "p"])


def segment_heads(numbered_points: DataFrame) -> DataFrame:
    """V-3, V-5 without the lists: one row per segment with the attributes of its first
    active interval, its bounds and ``n_active``, from points with ``first`` and ``n_active``.
    Linear in points, whatever overlaps."""
    g = numbered_points.filter(F.col("n_active") > 0)
    attrs = [(F.col(c) if c == "video_id" else F.col("first").getField(c)).alias(out) for c, out in ATTRS]
    return g.select(F.col("p").alias("seg_no"), *attrs, *_times("t_prev", "t"), "n_active")


def _times(begin: str, end: str) -> list:
    return [F.concat_ws("_", F.col(begin).cast("string"), F.col(end).cast("string")).alias("string_time"),
            (F.col(end) - F.col(begin)).cast("string").alias("string_time_long")]


def _sorted_items(m: DataFrame):
    # pb (the interval's begin-point number) orders intervals like (begin, tie-break):
    # one long to sort on instead of the tie-break struct.
    item = F.struct(F.col("pb"),
                    F.col("class_type_id").cast("string").alias("cls"),
                    F.col("class3_name").alias("c3"), F.col("class2_name").alias("c2"),
                    F.col("ad_seat_img").alias("img"))
    return F.array_sort(F.collect_list(item))


def _is_class(cls: str):
    # One-argument lambda: F.filter treats a two-argument one as (element, index).
    return lambda x: x["cls"] == F.lit(cls)


def segments(m: DataFrame, max_items: int | None = None) -> DataFrame:
    """V-3 ... V-5: one row per segment with the reference's document fields.

    Attributes come from the first active interval in interval order; the twelve
    lists keep interval order and are not de-duplicated.

    By default a segment's lists are one row, as in the reference's documents. With
    ``max_items`` each segment becomes ordered parts (``part`` 0, 1, ...) of at most
    ``max_items`` active intervals. Members are numbered inside the segment with the
    skew-safe ``rank_within``, so no row or task holds more than ``max_items`` of them.
    The per-segment attributes and ``n_active`` are partial + final aggregates.
    """
    first_attrs = F.min_by(F.struct(*[F.col(c) for c, _ in ATTRS]), F.col("pb"))
    seg = ["video_id", "p"]
    head = [F.min("t_prev").alias("_tb"), F.min("t").alias("_te"), first_attrs.alias("_a"),
            F.count(F.lit(1)).alias("n_active")]
    if max_items:
        numbered = rank_within(m, seg, ["pb"], out="_r").withColumn(
            "part", F.floor((F.col("_r") - 1) / max_items).cast("long"))
        lists = numbered.groupBy(*seg, "part").agg(_sorted_items(numbered).alias("_items"))
        g = lists.join(m.groupBy(*seg).agg(*head), seg)
        part = [F.col("part")]
    else:
        g = m.groupBy(*seg).agg(*head, _sorted_items(m).alias("_items"))
        part = []
    cols = [F.col(f"_a.{c}").alias(out) for c, out in ATTRS]
    cols += _times("_tb", "_te")
    for cls, name in CLASS_LISTS:
        of_cls = F.filter("_items", _is_class(cls))
        cols += [F.transform(of_cls, lambda x: x["c3"]).alias(f"string_{name}_list"),
                 F.transform(of_cls, lambda x: x["c2"]).alias(f"string_{name}2_list"),
                 F.transform(of_cls, lambda x: x["img"]).alias(f"string_{name}_img_list")]
    return g.select(F.col("p").alias("seg_no"), *part, *cols, "n_active")


LIST_COLUMNS = tuple(f"string_{name}{suffix}" for _, name in CLASS_LISTS
                     for suffix in ("_list", "2_list", "_img_list"))
DOC_COLUMNS = tuple(out for _, out in ATTRS) + ("string_time", "string_time_long") + LIST_COLUMNS


def to_documents(segs: DataFrame) -> DataFrame:
    """V-7: one JSON document per segment (null fields omitted), with a stable id
    so a re-run can overwrite instead of duplicating. Parts of a segment (``part``) are
    documents of their own: the part is in the id and in the document."""
    part = [F.col("part")] if "part" in segs.columns else []
    doc_id = F.sha2(F.concat_ws("|", F.col("string_vid"), F.col("seg_no").cast("string"),
                                *[c.cast("string") for c in part]), 256)
    return segs.select("string_vid", "seg_no", *part, doc_id.alias("doc_id"),
                       F.to_json(F.struct(*DOC_COLUMNS, *part)).alias("doc"))


def prepare_intervals(seats: DataFrame, usable: DataFrame, tie: str = "sid", pad_ms: int = PAD_MS) -> DataFrame:
    """Usable, kept, padded, valid intervals, checkpointed once (shared checkpoint
    folder): they feed several scans and joins, which then read files instead of
    recomputing the table scans and joins."""
    return checkpointed(valid(pad(join_usable(seats, usable, tie), pad_ms)))


def segment_videos(seats: DataFrame, usable: DataFrame, tie: str = "sid", pad_ms: int = PAD_MS,
                   max_items: int | None = None, hot: bool | None = None) -> DataFrame:
    """R-11 end to end: usable join, class filter, padding, sweep -> segments
    (``max_items``: see ``segments``).

    Ranked intervals and numbered points each feed several steps, so they are
    checkpointed once (no cached data left behind in a long session). ``hot`` forces the
    range-partitioned (True) or the window plan (False); measured if None."""
    return segments(_swept(prepare_intervals(seats, usable, tie, pad_ms), hot), max_items)


def segment_heads_of(seats: DataFrame, usable: DataFrame, tie: str = "sid", pad_ms: int = PAD_MS,
                     hot: bool | None = None) -> DataFrame:
    """R-11 without the tag lists, in linear space (``segment_heads``). Only the columns that
    the heads need are staged."""
    iv = checkpointed(valid(pad(join_usable(seats, usable, tie), pad_ms)).select(*[c for c, _ in ATTRS], "b", "e", *IKEY))
    hot = is_hot(2 * largest_group(iv, ["video_id"])) if hot is None else hot
    ranked = checkpointed(interval_rank(iv, hot, leading="_leading").drop(*IKEY))
    return segment_heads(points(ranked, hot, leading="_leading"))


def segment_intervals(iv: DataFrame, max_items: int | None = None, hot: bool | None = None) -> DataFrame:
    """Segments of valid padded intervals (``valid``)."""
    return segments(_swept(iv, hot), max_items)


def _swept(iv: DataFrame, hot: bool | None) -> DataFrame:
    # One count answers both size questions: a video with n intervals has 2n points,
    # and no interval spans more than 2n of them.
    most_points = 2 * largest_group(iv, ["video_id"])
    hot = is_hot(most_points) if hot is None else hot
    ranked = checkpointed(interval_rank(iv, hot).drop(*IKEY))
    return members(ranked, checkpointed(points(ranked, hot)), longest=most_points)


def bounded_collect(intervals: DataFrame, chunk: int = 1000, tie: str = "sid", hot: bool | None = None) -> DataFrame:
    """A-6 in bounded pieces: the rows of a video as JSON documents, at most ``chunk``
    per output row, in (begin, tie-break) order. A hot video becomes many rows
    instead of one unbounded array."""
    kept = intervals.filter(F.col("class_type_id").cast("string").isin(*KEPT_CLASSES))
    kept = kept.withColumn("_b", F.col("ad_seat_b_time").try_cast("bigint"))
    ranked = rank_within(kept, ["video_id"], ["_b", tie, "copy"], out="_rn", hot=hot)
    doc = F.to_json(F.struct(*[F.col(c) for c in SEAT_COLUMNS]))
    g = (ranked.groupBy("video_id", F.floor((F.col("_rn") - 1) / chunk).alias("chunk"))
         .agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("_rn", doc.alias("d")))).alias("_docs")))
    return g.select("video_id", "chunk", "n",
                    F.concat(F.lit("["), F.array_join(F.transform("_docs", lambda x: x["d"]), ","), F.lit("]")).alias("rows_json"))


def merge_overlaps(iv: DataFrame, tag: str = "class3_name", hot: bool | None = None) -> DataFrame:
    """V-6 (described, commented out in the reference): per (video, tag), merge padded
    intervals that overlap into islands. An interval starts a new island unless it
    begins strictly before the largest end seen so far (touching ones stay apart).

    Both running values (largest end so far, last island start) are skew-safe
    prefix scans; the islands are then a partial + final aggregate.
    """
    order = ["b", *IKEY]
    grp = ["video_id", tag]
    if hot is None:
        hot = is_hot(largest_group(iv, grp))  # both scans go over the same groups
    with_prev = prefix_within(iv, grp, order, "e", "max", out="_prev_e", hot=hot)
    starts = with_prev.withColumn(
        "_start", F.when(F.col("_prev_e").isNull() | (F.col("b") >= F.col("_prev_e")),
                         F.struct(*[F.col(c) for c in order])))
    islands = prefix_within(starts, grp, order, "_start", "max", out="_island", inclusive=True, hot=hot)
    return (islands.groupBy(*grp, "_island")
            .agg(F.min("b").alias("b"), F.max("e").alias("e"), F.count(F.lit(1)).alias("n_merged"))
            .drop("_island"))
