import random

import plain
from pyspark.sql import functions as F

from adlens.llm import simhash


def test_fingerprints_equal_the_definition(odd_docs):
    for r in simhash.fingerprints(odd_docs).join(odd_docs.withColumn("text_key", F.xxhash64("text")).select("text_key", "text"), "text_key").distinct().collect():
        assert r["fp"] % 2**64 == plain.simhash(r["text"]), r["text"]


def clusters(rng):
    """Random fingerprints, chains of close ones, and one dense ball that overfills buckets."""
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in fps[:30]:
        for _ in range(6):
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            fps.append(f)
    centre = rng.getrandbits(64)
    for _ in range(120):
        f = centre
        for b in rng.sample(range(64), rng.randrange(5)):
            f ^= 1 << b
        fps.append(f)
    return fps + [0, 2**64 - 1, 3]


def test_links_join_what_all_pairs_join(spark):
    rng = random.Random(4)
    for bits in (1, 2):
        fps = clusters(rng)
        df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in set(fps)], "fp long")
        found = [(r["u"] % 2**64, r["v"] % 2**64) for r in simhash.links(df, bits, bucket=4).collect()]
        assert all((u ^ v).bit_count() <= bits for u, v in found)
        assert len(found) < 40 * len(fps)
        want, got = plain.components(fps, bits), {f: f for f in fps}

        def find(x):
            while got[x] != x:
                x = got[x]
            return x

        for u, v in found:
            a, b = find(u), find(v)
            got[max(a, b)] = min(a, b)
        assert {f: find(f) for f in fps} == want


def test_groups_and_keep_one(odd_docs):
    rows = simhash.groups(odd_docs).collect()
    fps = [plain.simhash(r["text"]) for r in odd_docs.collect()]
    root = plain.components(fps)
    least = {}
    for r, f in zip(odd_docs.collect(), fps):
        if r["doc_id"] is not None:
            least[root[f]] = min(least.get(root[f], r["doc_id"]), r["doc_id"])
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r["component_id"] == least.get(root[r["fp"] % 2**64])
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len(set(root.values()))


def test_empty_table(no_docs):
    assert simhash.groups(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0
