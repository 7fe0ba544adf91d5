"""Merkle manifest of a dataset by cogrouped subtree exchange (operator 13).

Every row is a leaf. Leaves of a group (a source) stand in key order under a tree of
fixed arity, and the groups' roots stand in group order under one more tree. While
several nodes remain on a level, each run of ``arity`` consecutive ones becomes their hash.

Trees of any size are worked in superblocks of ``arity ** height`` consecutive nodes, so no
task ever holds more than one superblock of a group:

* upwards, each superblock is reduced to its root; the roots are the next round's nodes,
  until each tree has one (a superblock of 2,187 leaves: a billion leaves take three rounds);
* downwards, a round's nodes and the required outer nodes (what lies beside the path of
  their superblock's root, up to the dataset's root: one row per superblock) are cogrouped by
  superblock. One ``applyInPandas`` finishes the local reduction, joins the proofs of both
  parts and, for the leaves, folds them.

Texts are hashed where they are read; only hashes and keys are shuffled. Places inside a
group come from a range sort and carried counts, so a group holding a third of all rows
spreads over as many tasks as its rows need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import partitions, staged

ARITY, HEIGHT = 3, 7
TREE = ["nul", "grp"]  # a tree's key; a null group is told apart by ``nul``
NODES = "nul boolean, grp string, i long, n long, h string"
OUTER = "before array<string>, after array<string>, subroot string, root string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def item(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """SHA-256 (lower-case hex) of the items of ``values``."""
    return F.sha2(F.concat(*map(item, values)).cast("binary"), 256)


def levels(nodes: list[str], arity: int, height: int | None) -> list[list[str]]:
    """``nodes`` and every level above: up to one node, or exactly ``height`` levels up."""
    out = [nodes]
    while len(out[-1]) > 1 if height is None else len(out) <= height:
        at = out[-1]
        out.append([digest(*at[j:j + arity]) for j in range(0, len(at), arity)])
    return out


def path(tree: list[list[str]], i: int, arity: int) -> Iterator[tuple[str, str]]:
    """Siblings (those before, those after) of node ``i`` on each level but the last."""
    for level in tree[:-1]:
        start = i // arity * arity
        yield "".join(level[start:i]), "".join(level[i + 1:start + arity])
        i //= arity


def fold(node: str, siblings: list[tuple[str, str]]) -> str:
    for before, after in siblings:
        node = digest(before, node, after)
    return node


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``i``, their place in their tree from 0, and ``n``, the tree's size."""
    spark = rows.sparkSession
    ranged = staged(rows.repartitionByRange(partitions(spark), *TREE, *order).withColumn("part", F.spark_partition_id()), name)
    held = ranged.groupBy(*TREE, "part").agg(F.count("*").alias("held"))
    tree = Window.partitionBy(*TREE)
    carried = held.select(*TREE, "part", F.sum("held").over(tree).alias("n"),
                          F.coalesce(F.sum("held").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("carried"))
    inside = F.row_number().over(Window.partitionBy("part", *TREE).orderBy(*order))
    return (ranged.withColumn("inside", inside).join(carried, [*TREE, "part"])
            .withColumn("i", F.col("carried") + F.col("inside") - 1).drop("part", "inside", "carried"))


def _by_block(nodes: DataFrame, width: int) -> DataFrame:
    """Nodes with their superblock, one superblock never in two partitions. The number of
    partitions is fixed: adaptive execution would merge the blocks into a few tasks."""
    return nodes.withColumn("block", F.expr(f"i div {width}L")).repartition(partitions(nodes.sparkSession), *TREE, "block")


def _reduced(nodes: DataFrame, arity: int, height: int) -> DataFrame:
    """One node per superblock: the next round's nodes."""
    width = arity ** height

    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i")
        n = int(block["n"].iloc[0])
        top = levels(block["h"].tolist(), arity, None if n <= width else height)[-1][0]
        return pd.DataFrame({"nul": [key[0]], "grp": [key[1]], "i": [key[2]], "n": [-(-n // width)], "h": [top]})

    return _by_block(nodes.select("nul", "grp", "i", "n", "h"), width).groupBy(*TREE, "block").applyInPandas(run, NODES)


def _rounds(nodes: DataFrame, most: int, arity: int, height: int, name: str) -> list[DataFrame]:
    """Nodes of every round: the given ones, then superblock roots, until every tree
    (the largest has ``most`` nodes) has one. A tree takes part until it has one node."""
    out, width = [nodes], arity ** height
    while True:
        out.append(staged(_reduced(out[-1] if len(out) == 1 else out[-1].filter("n > 1"), arity, height), f"{name}-{len(out)}"))
        most = -(-most // width)
        if most <= 1:
            return out


def _paths(nodes: DataFrame, outer: DataFrame, arity: int, height: int) -> DataFrame:
    """(nul, grp, i, before, after, subroot, root) per node: its siblings up to the dataset's
    root, from its superblock and the outer nodes of that superblock."""
    width = arity ** height

    def run(block: pd.DataFrame, out: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i").reset_index(drop=True)
        tree = levels(block["h"].tolist(), arity, None if int(block["n"].iloc[0]) <= width else height)
        o = out.iloc[0]
        steps = [list(path(tree, k, arity)) for k in range(len(block))]
        return pd.DataFrame({"nul": block["nul"], "grp": block["grp"], "i": block["i"],
                             "before": [[b for b, _ in s] + list(o["before"]) for s in steps],
                             "after": [[a for _, a in s] + list(o["after"]) for s in steps], "subroot": o["subroot"], "root": o["root"]})

    left = _by_block(nodes.select("nul", "grp", "i", "n", "h"), width).groupBy(*TREE, "block")
    return left.cogroup(_outer_by_block(outer)).applyInPandas(run, f"nul boolean, grp string, i long, {OUTER}")


def _outer_by_block(outer: DataFrame):
    keyed = outer.select("nul", "grp", F.col("i").alias("block"), "before", "after", "subroot", "root")
    return keyed.repartition(partitions(outer.sparkSession), *TREE, "block").groupBy(*TREE, "block")


def prove(leaves: DataFrame, arity: int = ARITY, height: int = HEIGHT, proofs: bool = False) -> DataFrame:
    """Proofs of ``leaves`` (doc_id, grp, leaf, claim): per leaf (doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified), with ``proofs`` also (before, after), the siblings
    of each level.

    Leaves of a group stand in order of doc_id, null first; rows that share one in order of
    their hashes. ``claim`` (null: the leaf itself) is folded with the original siblings;
    ``verified`` tells whether that gives the dataset's root. Groups stand in byte order, a null
    group first. An empty table gives no rows.
    """
    spark = leaves.sparkSession
    columns = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if proofs:
        columns += ", before array<string>, after array<string>"
    keyed = leaves.select(F.col("grp").isNull().alias("nul"), F.coalesce("grp", F.lit("")).alias("grp"),
                          "doc_id", F.col("leaf").alias("h"), "claim")
    placed = staged(numbered(keyed, [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("claim")], "leaves"), "placed")
    most = placed.agg(F.max("n")).first()[0]
    if most is None:
        return spark.createDataFrame([], columns).withColumn("doc_id", F.col("doc_id").cast("long"))

    # Up: every group's tree, then the tree of the groups' roots, whose key is one constant.
    rounds = _rounds(placed, most, arity, height, "nodes")
    subroots = rounds[1].filter("n = 1")
    for nodes in rounds[2:]:
        subroots = subroots.unionByName(nodes.filter("n = 1"))
    tops = numbered(subroots.select(F.lit(False).alias("nul"), F.lit("").alias("grp"), F.col("nul").alias("of_nul"),
                                    F.col("grp").alias("of_grp"), "h"), [F.col("of_nul").desc(), F.col("of_grp")], "subroots")
    tops = staged(tops, "tops")
    top_rounds = _rounds(tops, tops.count(), arity, height, "tops")

    # Down: the outer nodes of each round's superblocks.
    none = F.array().cast("array<string>")
    outer = top_rounds[-1].select("nul", "grp", "i", none.alias("before"), none.alias("after"), F.lit("").alias("subroot"), F.col("h").alias("root"))
    for nodes in reversed(top_rounds[:-1]):
        outer = staged(_paths(nodes, outer, arity, height), "outer")
    above = tops.join(outer.drop("subroot"), [*TREE, "i"]).select(
        F.col("of_nul").alias("nul"), F.col("of_grp").alias("grp"), F.lit(0).cast("long").alias("i"),
        "before", "after", F.col("h").alias("subroot"), "root")
    above = staged(above, "above")
    outer = None
    for r in range(len(rounds) - 1, 0, -1):
        done = above.join(rounds[r].filter("n = 1").select(*TREE), TREE)  # trees whose root is of this round
        outer = done if outer is None else done.unionByName(staged(_paths(rounds[r].filter("n > 1"), outer, arity, height), "outer"))

    width = arity ** height

    def run(block: pd.DataFrame, out: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i")
        nodes = block["h"].tolist()
        tree = levels(nodes, arity, None if int(block["n"].iloc[0]) <= width else height)
        o = out.iloc[0]
        outside, subroot, root = list(zip(o["before"], o["after"])), o["subroot"], o["root"]
        rows = []
        for k, (doc, claim) in enumerate(zip(block["doc_id"], block["claim"])):
            steps = [*path(tree, k, arity), *outside]
            end = fold(nodes[k] if claim is None else claim, steps)
            rows.append((doc, nodes[k], subroot, root, digest(*[s for step in steps for s in step]), end, end == root,
                         *(([b for b, _ in steps], [a for _, a in steps]) if proofs else ())))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in columns.split(", ")])

    # doc_id travels as text: pandas would turn ids with nulls into floats.
    blocks = _by_block(placed.withColumn("doc_id", F.col("doc_id").cast("string")), width).groupBy(*TREE, "block")
    proved = blocks.cogroup(_outer_by_block(outer)).applyInPandas(run, columns)
    return proved.withColumn("doc_id", F.col("doc_id").cast("long"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered(doc_id: Column) -> Column:
    """Does the query tamper with this row? (2 divides the crc32 of its id; never a null id.)"""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 2 == 0, F.lit(False))


def manifest(docs: DataFrame, arity: int = ARITY, height: int = HEIGHT, proofs: bool = False) -> DataFrame:
    """:func:`prove` over ``docs`` (doc_id, source, lang, n_chars, text) by source, claiming for
    about half of the rows a text without its line ends, which must fail wherever there
    was one.

    Nulls are items of their own (`-`), so a null and an empty text differ; texts are read
    whole; extra columns are not carried.
    """
    bare = F.regexp_replace("text", "\n", "")
    changed = tampered(F.col("doc_id")) & F.col("text").contains("\n")
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("grp"), leaf(*map(F.col, FIELDS)).alias("leaf"),
                         F.when(changed, leaf(*[bare if c == "text" else F.col(c) for c in FIELDS])).alias("claim"))
    return prove(staged(leaves, "hashes"), arity, height, proofs)


def verify(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """(doc_id, verified) per row of ``docs``, checked against a stored manifest with proofs.

    A row is verified if the manifest holds its leaf under its doc_id and the proof folds to
    the root; a changed, added or foreign row is not. Rows lost from ``docs`` are not listed.
    """
    fields = [F.col(c) for c in FIELDS]
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), leaf(*fields).alias("leaf"))
    known = manifest.select("doc_id", "leaf", "root", "before", "after").dropDuplicates(["doc_id", "leaf"])
    folded = F.aggregate(F.arrays_zip("before", "after"), F.col("k_leaf"),
                         lambda f, s: F.sha2(F.concat(s["before"], f, s["after"]).cast("binary"), 256))
    known = known.select(F.col("doc_id").alias("k_doc"), F.col("leaf").alias("k_leaf"), "root", "before", "after")
    joined = mine.join(known, mine["doc_id"].eqNullSafe(known["k_doc"]) & (mine["leaf"] == known["k_leaf"]), "left")
    return joined.select("doc_id", F.coalesce(folded == F.col("root"), F.lit(False)).alias("verified"))
