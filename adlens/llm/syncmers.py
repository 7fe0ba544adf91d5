"""Document fingerprints from closed syncmers (operator 10, DataFrame functions only).

A text is read as words. A k-mer (``k`` words in a row) is a closed syncmer if the least
of its inner s-mers (``s`` words in a row, by hash) stands at its first or last place.
Whether a k-mer is chosen depends on its own words alone, so texts that share a passage
choose the same anchors in it wherever it stands. At least one of any k - s + 1
neighbouring k-mers is chosen. A fingerprint lists the hashes of a text's anchors.

The alphabet is words or, for the query, code points: half a word, a short text and a
script without spaces then have anchors like any other passage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import let, partitions, word_array

K, S = 6, 2
CHAR_K, CHAR_S = 10, 3  # k - s + 1 is a power of two


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Closed syncmers of a text in order: array of (pos: word number from 0, hash).

    A text of fewer than ``k`` words has one anchor, its whole word sequence; a text
    without words (or null) has none.
    """
    def hashes(words: Column) -> Column:
        return F.transform(words, lambda w: F.xxhash64(w))

    def run(h: Column, at: Column, length: int) -> Column:
        return F.xxhash64(*[F.get(h, at + j) for j in range(length)])

    def chosen(h: Column) -> Column:
        inner = F.transform(F.sequence(F.lit(0), F.size(h) - s), lambda i: run(h, i, s))
        last = k - s

        def closed(m: Column) -> Column:
            edge = lambda i: F.least(F.get(m, i), F.get(m, i + last))
            every = lambda i: F.least(*[F.get(m, i + j) for j in range(last + 1)])
            starts = F.filter(F.sequence(F.lit(0), F.size(h) - k), lambda i: edge(i) == every(i))
            return F.transform(starts, lambda i: F.struct(i.alias("pos"), run(h, i, k).alias("hash")))

        return let(inner, closed)

    whole = lambda h: F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(h).alias("hash")))
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return let(hashes(word_array(text)),
               lambda h: F.when(F.size(h) == 0, none).when(F.size(h) < k, whole(h)).otherwise(chosen(h)))


def char_anchors(text: Column, k: int = CHAR_K, s: int = CHAR_S) -> Column:
    """Closed syncmers of a text's code points in order: struct of the arrays pos (code
    point number from 0) and hash.

    A text of fewer than ``k`` code points has one anchor, the whole text; an empty or
    null text has none, and texts of under 2k - s code points may have none
    (:func:`char_anchor_set` then takes the whole). ``k - s + 1`` must be a power of two.
    """
    def whole(c: Column) -> Column:
        return F.struct(F.array(F.lit(0)).alias("pos"), F.array(F.xxhash64(c)).alias("hash"))

    none = F.struct(F.array().cast("array<int>").alias("pos"), F.array().cast("array<bigint>").alias("hash"))
    return let(F.split(F.coalesce(text, F.lit("")), ""),
               lambda c: F.when(F.coalesce(text, F.lit("")) == "", none).when(F.size(c) < k, whole(c)).otherwise(_char_chosen(c, k, s)))


def _char_chosen(c: Column, k: int, s: int) -> Column:
    """The closed syncmers of an array of at least ``k`` code points (pos, hash)."""
    width = k - s + 1
    if width & (width - 1):
        raise ValueError("k - s + 1 must be a power of two")
    mers = F.slice(F.transform(c, lambda x, i: F.xxhash64(x, *[F.get(c, i + j) for j in range(1, s)])), F.lit(1), F.size(c) - (s - 1))

    def least(m: Column, n: int) -> Column:
        """The least of ``n`` neighbours from each place on, by doubling."""
        if n == 1:
            return m
        return let(least(m, n // 2), lambda a: F.zip_with(a, F.slice(a, F.lit(n // 2 + 1), F.size(a)), lambda x, y: F.least(x, y)))

    def closed(h: Column) -> Column:
        # s-mers at every s-th place, and the last one, cover a k-mer
        run = lambda i: F.xxhash64(*[F.get(h, i + j) for j in [*range(0, k - s, s), k - s]])
        at = let(least(h, width), lambda m: F.filter(F.sequence(F.lit(0), F.size(c) - k),
                                                     lambda i: F.least(F.get(h, i), F.get(h, i + (width - 1))) == F.get(m, i)))
        return let(at, lambda p: F.struct(p.alias("pos"), F.transform(p, run).alias("hash")))

    return let(mers, closed)


def char_anchor_set(text: Column, k: int = CHAR_K, s: int = CHAR_S) -> Column:
    """The distinct hashes of a text's code point anchors, in order of first appearance. A text
    without one (empty texts aside) has its whole as its anchor."""
    return _or_whole(F.array_distinct(char_anchors(text, k, s)["hash"]), text)


def _or_whole(hashes: Column, text: Column) -> Column:
    """Up to k + (k - s) - 1 code points may hold no closed syncmer; two such texts must not
    look alike for having no anchors."""
    bare = (F.size(hashes) == 0) & (F.coalesce(text, F.lit("")) != "")
    return F.when(bare, F.array(F.xxhash64(F.split(text, "")))).otherwise(hashes)


def anchor_set(text: Column, k: int = K, s: int = S) -> Column:
    """The distinct anchor hashes of a text, in order of first appearance."""
    return F.array_distinct(F.transform(anchors(text, k, s), lambda a: a["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Shared part of two anchor sets (Jaccard), 0 to 1; two empty sets are alike (1)."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def shared_passages(a: DataFrame, b: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Positional matches of two tables (doc_id, text): one row (left_id, right_id, shift,
    first, last, anchors) per pair and shift of word positions with a common anchor.

    Anchors join on their hash, so a hash that is frequent on both sides gives the
    product of its rows: the answer's own size, as every such pair shares a passage.
    """
    side = lambda df, p: df.select(F.col("doc_id").alias(f"{p}_id"), F.explode(anchors(F.col("text"), k, s)).alias(p))
    left, right = side(a, "left"), side(b, "right")
    hit = left.join(right, F.col("left.hash") == F.col("right.hash"))
    return (hit.groupBy("left_id", "right_id", (F.col("left.pos") - F.col("right.pos")).alias("shift"))
            .agg(F.min("left.pos").alias("first"), F.max("left.pos").alias("last"), F.count("*").alias("anchors")))


def shortened(hashes: Column) -> Column:
    """A fingerprint: the anchors' distinct hashes, shortened to 32 bits."""
    return F.array_distinct(F.transform(hashes, lambda h: F.shiftright(h, 32).cast("int")))


def render(hashes: Column) -> Column:
    """A fingerprint as text, its hashes separated by spaces."""
    return F.array_join(F.transform(shortened(hashes), lambda h: h.cast("string")), " ")


def spread_keys(spark, n: int) -> list[int]:
    """``n`` integers of which hash partitioning over ``n`` partitions sends the i-th to the i-th."""
    tried = spark.range(0, 64 * n).select(F.col("id").cast("int").alias("key"))
    found = tried.groupBy(F.pmod(F.hash("key"), F.lit(n)).alias("at")).agg(F.min("key").alias("key")).collect()  # n rows
    keys = {r["at"]: r["key"] for r in found}
    return [keys.get(i, -1 - i) for i in range(n)]


def with_next(docs: DataFrame, buckets: int | None = None, carry: Callable[[Column], Column] | None = None) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with ``next_text``, the text of the next row in
    ascending (doc_id, text) order. The last row's next is the first row. With ``carry``,
    a function of a text, also ``own`` and ``next_own``: its values for both texts,
    computed once per row, after the rows were dealt.

    Rows are dealt once, into buckets of consecutive doc_ids cut at quantiles. Within a
    bucket the next row is a window's ``lead``; a bucket's last row takes the first row of
    the next bucket that has rows, one row per bucket.
    """
    buckets = buckets or partitions(docs.sparkSession)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)] or [0.5], 20 * buckets)).first()[0] or []
    edges = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    # Bucket b carries a key that hash partitioning sends to partition b: no two share a task.
    n = len(set(cuts)) + 2
    keys = F.array(*[F.lit(x) for x in spread_keys(docs.sparkSession, n)])
    turn = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.size(F.filter(edges, lambda e: e <= F.col("doc_id"))) + 1)
    rows = docs.select("doc_id", "text", F.get(keys, turn).alias("bucket"))
    inside = Window.partitionBy("bucket").orderBy("doc_id", "text")
    own = [] if carry is None else ["own"]
    dealt = rows.repartition(n, "bucket")
    if carry is not None:  # dealt and sorted as the window wants it, so that values are not moved
        dealt = dealt.sortWithinPartitions("bucket", "doc_id", "text").withColumn("own", carry(F.col("text")))
    led = dealt.withColumn("led", F.lead(F.struct("text", *own)).over(inside))
    # First rows of the buckets: only the doc_ids that open one are read again with their texts.
    opens = F.broadcast(rows.groupBy("bucket").agg(F.min("doc_id").alias("open"))  # a number per bucket
                        .select(F.col("bucket").alias("b"), "open"))
    heads = (rows.join(opens, (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("open")))
             .groupBy("bucket").agg(F.min("text").alias("text")))
    if carry is not None:
        heads = heads.withColumn("own", carry(F.col("text")))
    order = Window.orderBy(F.array_position(keys, F.col("bucket")))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    head = F.struct("text", *own)
    after = heads.select("bucket", F.coalesce(F.lead(head).over(order), F.first(head).over(every)).alias("after"))
    return (led.join(after, "bucket").withColumn("next", F.coalesce("led", "after"))
            .select("doc_id", "text", F.col("next.text").alias("next_text"), *own, *[F.col(f"next.{c}").alias(f"next_{c}") for c in own]))


def fingerprint_edits(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, n_anchors.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next document. Null texts count as empty; rows that share a
    doc_id follow each other in text order; null doc_ids come first; extra columns are
    not carried; an empty table gives no rows; a single row is its own next.
    """
    base, n, half = _halves(docs)
    # Anchors are chosen after the rows were dealt: texts alone are shuffled.
    edited = with_next(base).select(
        "doc_id", n.cast("long").alias("n_chars"), anchor_set(F.col("text"), k, s).alias("prints"),
        anchor_set(F.col("next_text"), k, s).alias("next_prints"),
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    return _report(edited.withColumn("edited_prints", anchor_set(F.col("edited"), k, s)))


def fingerprint_char_edits(docs: DataFrame, k: int = CHAR_K, s: int = CHAR_S) -> DataFrame:
    """:func:`fingerprint_edits` with code points as the alphabet.

    Anchors of a text are chosen once. They are context-free, so the edited text's are the
    kept half's, the replacing half's and those of the k-mers across the seam.
    """
    base, n, half = _halves(docs)
    kept, brought = n - half, F.least(half, F.char_length("next_text"))
    seam = F.concat(F.substring(F.substring("text", F.lit(1), kept), -(k - 1), k - 1), F.substring("next_text", F.lit(1), F.least(brought, F.lit(k - 1))))

    def within(own: Column, length: Column) -> Column:
        # pos ascends; the length is bound, or every step would count the text's code points again
        fits = let(length, lambda most: F.size(F.filter(own["pos"], lambda p: p + k <= most)))
        return F.slice(own["hash"], F.lit(1), fits)

    across = F.when(F.char_length(seam) >= k, char_anchors(seam, k, s)["hash"]).otherwise(F.array().cast("array<bigint>"))
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring("next_text", F.lit(1), brought))
    own, other = F.col("own"), F.col("next_own")
    rows = with_next(base, carry=lambda t: char_anchors(t, k, s))
    return _report(rows.select(
        "doc_id", n.cast("long").alias("n_chars"), _or_whole(own["hash"], F.col("text")).alias("prints"),
        _or_whole(other["hash"], F.col("next_text")).alias("next_prints"), edited.alias("edited"),
        F.when(kept + brought < k, char_anchor_set(edited, k, s))
        .otherwise(_or_whole(F.concat(within(own, kept), across, within(other, brought)), edited)).alias("edited_prints")))


def _halves(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    n = F.char_length("text")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), n, F.floor(n / 2).cast("int")


def _report(both: DataFrame) -> DataFrame:
    """The likeness is that of the fingerprints shown, 32 bits a hash."""
    short = both.withColumns({c: shortened(F.col(c)) for c in ("prints", "edited_prints", "next_prints")})
    text = lambda c: F.array_join(F.transform(c, lambda h: h.cast("string")), " ")
    return short.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        text(F.col("prints")).alias("fingerprint"), text(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
        F.size("prints").cast("long").alias("n_anchors"))
