import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from adlens.llm import merkle, queries

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def item(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(r, text):
    return h(*map(item, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def reduce_with_paths(nodes, arity):
    """(root, siblings of each node level by level), written out level by level."""
    paths, at, place = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(at) > 1:
        for k, i in enumerate(place):
            start = i - i % arity
            paths[k].append((at[start:i], at[i + 1:start + arity]))
            place[k] = i // arity
        at = [h(*at[j:j + arity]) for j in range(0, len(at), arity)]
    return at[0], paths


def plain(rows, arity=3):
    by_source = {}
    for r in rows:
        even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        claim = leaf(r, r["text"].replace("\n", "") if even and r["text"] is not None else r["text"])
        own = leaf(r, r["text"])
        order = (r["doc_id"] is not None, r["doc_id"] or 0, own, claim if claim != own else "")
        by_source.setdefault(r["source"], []).append((order, r["doc_id"], own, claim))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: reduce_with_paths([x[2] for x in sorted(by_source[s], key=lambda x: x[0])], arity) for s in sources}
    root, outside = reduce_with_paths([trees[s][0] for s in sources], arity) if sources else (None, [])
    out = []
    for s, above in zip(sources, outside):
        for (_, doc, own, claim), inside in zip(sorted(by_source[s], key=lambda x: x[0]), trees[s][1]):
            node, proof = claim, []
            for before, after in inside + above:
                node = h(*before, node, *after)
                proof += before + after
            out.append((doc, own, trees[s][0], root, h(*proof), node, node == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op13_merkle_exchange(spark, SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = plain(docs)
    assert rows_of(got) == want
    assert {r[-1] for r in want} == {True, False}


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.withColumn("n_chars", F.when(F.col("doc_id") % 3 != 0, F.char_length("text"))).withColumn("leaf", F.lit(1)).withColumn("i", F.lit(2))
    assert rows_of(merkle.manifest(docs)) == plain(docs.collect())
    assert merkle.manifest(no_docs.withColumn("n_chars", F.lit(1))).count() == 0


@pytest.mark.parametrize("arity,height", [(3, 1), (3, 2), (2, 1), (4, 3)])
def test_trees_of_many_rounds(spark, arity, height):
    """Groups of 1 to 90 leaves and 33 groups: superblocks of 2 to 64 nodes, up to six rounds."""
    sizes = [1, 2, 3, 4, 5, 7, 8, 9, 10, 16, 17, 26, 27, 28, 32, 33, 64, 81, 82, 90] + [1, 2] * 6
    rows = [(1000 * g - k, f"g{g:02d}", "en", k, f"text {k}\nof {g}") for g, n in enumerate(sizes) for k in range(n)]
    rows += [(5, None, None, None, None), (6, "", None, 7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert rows_of(merkle.manifest(docs, arity, height)) == plain(docs.collect(), arity)


def test_one_group_and_one_leaf(spark):
    docs = spark.createDataFrame([(7, "s", "en", 3, "a\nb")], "doc_id long, source string, lang string, n_chars long, text string")
    got = rows_of(merkle.manifest(docs))
    assert got == plain(docs.collect())
    (row,) = got
    assert row[1] == row[2] == row[3] and row[4] == h()


def test_stored_manifest_verifies_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = merkle.manifest(docs, proofs=True)
    assert docs.count() == merkle.verify(docs, kept).filter("verified").count()
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 3, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    extra = docs.limit(1).withColumn("doc_id", F.lit(-1).cast("long"))
    bad = merkle.verify(changed.unionByName(extra), kept).filter("not verified").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in bad) == [-1, 3]
