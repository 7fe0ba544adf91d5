"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a partial ``min`` per node and a join on the node, so no component is
ever gathered in one task; each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import staged


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (both.filter("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(joined.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v: long) -> (node, root): every linked node but the roots, with the
    smallest node it reaches. Loops and repeated links are harmless; nulls are ignored;
    no links give an empty table. Rounds grow with the logarithm of the longest path.
    """
    edges = staged(links.select("u", "v").filter("u <> v").distinct(), "links")
    seen = _checksum(edges)
    while seen[0]:
        edges = staged(_small_star(_large_star(edges)), "star")
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
