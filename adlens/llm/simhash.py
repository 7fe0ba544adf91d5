"""SimHash near-duplicates found through pivot distance tables (operator 2).

Every distinct fingerprint gets its Hamming distances to many reference fingerprints:

* *unit references*: the zero fingerprint and the 64 fingerprints with one bit set.
  ``d(x, bit i) - d(x, 0)`` is +1 or -1, the i-th bit itself, so the table columns of a
  band of unit references are read off ``x`` with one mask. Two fingerprints at most
  ``k`` bits apart agree on all columns of at least ``bands - k`` of ``bands`` bands.
  These exact columns are the join keys that propose pairs.
* *spread references*: pseudo-random fingerprints. By the triangle inequality a pair is
  thrown away when any of its coordinates differs by more than ``k``; what is left is
  verified with ``bit_count(x ^ y) <= k``.

Random references alone can't propose pairs: one coordinate keeps about a third of all
pairs, so a join would have to replicate rows over many cells of many coordinates.

A key shared by more than ``bucket`` fingerprints would propose all pairs of its group.
Its members instead use the triangle inequality the other way: every fingerprint lists
the references within one bit of it (65), and two fingerprints are within two bits
exactly if they list a common one. A reference is listed by at most 65 fingerprints, so
stars around it hold every link of the group in linear space. (For ``k`` = 1 the lists
hold the fingerprint and its neighbours and the stars are verified too; ``k`` over 2
is not offered.)
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.common import staged
from adlens.llm.components import components

_BLOCK = 1 << 15


def fingerprint_bytes(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text as an unsigned 64-bit number (0 without words)."""
    words = data.lower().split()  # bytes: only A-Z change; cuts at the six ASCII gaps
    if not words:
        return 0
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        hashes = np.array([digest(joined[s:e], seed) for s, e in
                           zip(starts[at:at + _BLOCK].tolist(), ends[at:at + _BLOCK].tolist())], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp) per row of ``docs`` (doc_id, text); fp is signed.

    ``text_key`` tells rows that share a doc_id but not a text apart. A null text counts
    as empty (fingerprint 0); texts are read whole, whatever their length.
    """
    @F.pandas_udf(T.LongType())
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([np.uint64(fingerprint_bytes((t or "").encode("utf-8", "replace"), shingle, seed)).astype(np.int64)
                             for t in texts], dtype="int64")

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), fp("text").alias("fp"))


def spread_references(n: int, seed: int = 7) -> list[int]:
    """``n`` pseudo-random reference fingerprints (signed 64-bit)."""
    return np.random.default_rng(seed).integers(-2**63, 2**63 - 1, n).tolist()


def pivot_table(fps: DataFrame, references: int = 16) -> DataFrame:
    """fp -> (fp, dist): distances to the spread references, one byte each."""
    dist = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(r))).cast("tinyint")
                     for r in spread_references(references)])
    return fps.select("fp", dist.alias("dist"))


def _keys(bands: int, keep: int) -> list[int]:
    """One mask of unit references per choice of ``keep`` of ``bands`` bands."""
    edges = [64 * i // bands for i in range(bands + 1)]
    band = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(bands)]
    masks = [sum(c) for c in combinations(band, keep)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(fps: DataFrame, max_bits: int = 2, bands: int = 4, references: int = 16,
          bucket: int = 16) -> DataFrame:
    """Distinct ``fp`` -> (u, v) links whose components are those of all pairs within
    ``max_bits`` bits. Every returned link is such a pair."""
    if not 0 < max_bits <= 2 or bands <= max_bits:
        raise ValueError("max_bits must be 1 or 2, and bands larger")
    table = staged(pivot_table(fps, references), "pivots")
    keyed = table.select("fp", "dist", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m)) for m in _keys(bands, bands - max_bits)])).alias("tab", "key"))
    sizes = staged(keyed.groupBy("tab", "key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")

    small = keyed.join(sizes.filter(F.col("n") <= bucket), ["tab", "key"])
    a = small.select("tab", "key", F.col("fp").alias("u"), F.col("dist").alias("du"))
    b = small.select("tab", "key", F.col("fp").alias("v"), F.col("dist").alias("dv"))
    pairs = (a.join(b, ["tab", "key"]).filter("u < v")
             .filter(F.forall(F.zip_with("du", "dv", lambda x, y: F.abs(x - y)), lambda d: d <= max_bits))
             .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
             .select("u", "v"))

    crowded = keyed.join(sizes.filter(F.col("n") > bucket), ["tab", "key"], "left_semi").select("fp").distinct()
    flips = [0] + [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    near = crowded.select("fp", F.explode(F.array(
        *[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips])).alias("ref"))
    stars = (near.groupBy("ref").agg(F.collect_list("fp").alias("m")).filter(F.size("m") > 1)  # at most 65
             .select(F.array_min("m").alias("u"), "m") if max_bits == 2 else
             # one bit apart: one of the two is the reference itself
             near.groupBy("ref").agg(F.collect_list("fp").alias("m")).filter(F.array_contains("m", F.col("ref")))
             .select(F.col("ref").alias("u"), "m"))
    stars = (stars.select("u", F.explode("m").alias("v")).filter("u <> v")
             .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
    return pairs.unionByName(stars).distinct()


def groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp, component_id, keep_key) per row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id whose fingerprint is reachable over links of
    at most ``max_bits`` bits, itself included; equal fingerprints are always linked,
    also the zero of texts without words. ``keep_key`` is the text_key of the row that
    stands for the group (smallest (doc_id, text_key)). Null doc_ids are ignored when the
    smallest is taken; extra columns are not carried; an empty table gives no rows.
    """
    rows = staged(fingerprints(docs, shingle, seed), "simhash")
    # The head of a set of rows: smallest (doc_id, text_key), rows without a doc_id last.
    head = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    fps = staged(rows.groupBy("fp").agg(F.min(head).alias("head")), "fps")
    star = components(links(fps.select("fp"), max_bits))
    member = fps.join(star, fps["fp"] == star["node"], "left").select("fp", "head", F.coalesce("root", "fp").alias("root"))
    best = member.groupBy("root").agg(F.min("head").alias("best"))
    of_fp = member.join(best, "root").select("fp", F.col("best.doc_id").alias("component_id"),
                                             F.col("best.text_key").alias("keep_key"))
    return rows.join(of_fp, "fp").select("doc_id", "text_key", "fp", "component_id", "keep_key")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """Rows of ``docs`` with one row left of each group of near-duplicates: the one with
    the smallest doc_id. Columns stay as they are; of equal rows one stays."""
    g = groups(docs, shingle, max_bits, seed)
    identity = [F.col("doc_id").isNull().alias("k0"), F.coalesce("doc_id", F.lit(0)).alias("k1")]
    reps = (g.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("keep_key")))
            .select(*identity, F.col("text_key").alias("k2")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *identity, F.xxhash64("text").alias("k2"))
    nth = F.row_number().over(Window.partitionBy("k0", "k1", "k2").orderBy("k2"))
    return (rows.join(reps, ["k0", "k1", "k2"], "left_semi")
            .withColumn("nth", nth).filter("nth = 1").select("row.*"))
