import hashlib

import plain
import pytest
from pyspark.sql import functions as F

from adlens.llm import syncmers as sy


def test_anchors_equal_the_definition(odd_docs):
    for r in odd_docs.select("text", sy.anchors(F.col("text")).alias("a")).collect():
        assert [(x["pos"], x["hash"]) for x in r["a"]] == plain.syncmers(r["text"])


def test_anchors_are_context_free(spark):
    passage = " ".join(f"p{i * 7 % 31}" for i in range(60))
    df = spark.createDataFrame([(1, "before it " + passage), (2, passage + " after it"), (3, "nothing shared at all in here")], "doc_id long, text string")
    a, b = ({x["hash"] for x in r["a"]} for r in df.filter("doc_id < 3").orderBy("doc_id").select(sy.anchors(F.col("text")).alias("a")).collect())
    inside = {h for _, h in plain.syncmers(passage)}
    assert inside <= a and inside <= b and len(inside) >= 10
    hit = sy.shared_passages(df.filter("doc_id = 1"), df.filter("doc_id > 1")).collect()
    top = max(hit, key=lambda r: r["anchors"])
    assert (top["left_id"], top["right_id"], top["shift"]) == (1, 2, 2)


@pytest.mark.parametrize("buckets", [1, 3, 8])
def test_next_rows(odd_docs, buckets):
    docs = odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"].encode()) for r in docs.collect()))
    want = sorted((x, order[(i + 1) % len(order)][2]) for i, x in enumerate(order))
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"].encode()), r["next_text"].encode())
                 for r in sy.with_next(docs, buckets).collect())
    assert got == want


def test_edits(odd_docs, no_docs):
    docs = odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"].encode()) for r in docs.collect()))
    want = []
    for i, (has, d, t) in enumerate(order):
        t, nxt = t.decode(), order[(i + 1) % len(order)][2].decode()
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, e, n = ({h for _, h in plain.syncmers(x)} for x in (t, edited, nxt))
        alike = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        want.append((has, d, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(alike(a, e), 9), round(alike(a, n), 9)))
    rows = sy.fingerprint_edits(odd_docs).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows) == sorted(want)
    same = [r["fingerprint"] for r in rows if r["doc_id"] == 5]
    assert len(same) == 4 and len(set(same)) == 2
    assert sy.fingerprint_edits(no_docs).count() == 0
    single = sy.fingerprint_edits(odd_docs.filter("doc_id = 6")).first()
    assert single["near_next"] == 1.0


def test_no_python_on_the_main_path(odd_docs):
    plan = sy.fingerprint_edits(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_code_point_edits_equal_the_direct_way(odd_docs, no_docs):
    got, direct = sy.fingerprint_char_edits(odd_docs), sy.with_next(odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    a, e, x = (sy.char_anchor_set(c) for c in (F.col("text"), edited, F.col("next_text")))
    want = direct.select("doc_id", n.cast("long"), F.sha2(edited, 256), sy.render(a), F.array_sort(F.split(sy.render(e), " ")),
                         F.round(sy.likeness(a, e), 9), F.round(sy.likeness(a, x), 9))
    have = got.select("doc_id", "n_chars", "edited_sha256", "fingerprint", F.array_sort(F.split("edited_fingerprint", " ")),
                      F.round("near_edited", 9), F.round("near_next", 9))
    assert sorted(map(repr, map(tuple, have.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    assert sy.fingerprint_char_edits(no_docs).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_texts_without_a_syncmer_are_not_alike(spark):
    """10 to 17 code points may hold no closed syncmer: their whole is their anchor."""
    texts = ["klmnopqrst", "uvwxyz0123", "", "klmnopqrst", "abcdefghijklmno", "0123456789abcdefg", "ponmlkjihgfedcba"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in sy.fingerprint_char_edits(docs).collect()}
    bare = [t for t, r in zip(texts, docs.orderBy("doc_id").select(F.size(sy.char_anchors(F.col("text"))["hash"]).alias("n")).collect()) if t and not r["n"]]
    assert bare  # the case is there
    for i, t in enumerate(texts):
        assert (rows[i]["fingerprint"] == "") == (t == "")
        assert rows[i]["near_next"] == (1.0 if t == texts[(i + 1) % len(texts)] else 0.0)
    assert rows[0]["fingerprint"] == rows[3]["fingerprint"] != rows[1]["fingerprint"]


def test_likeness_is_that_of_the_fingerprints(odd_docs):
    rows = sy.fingerprint_char_edits(odd_docs).collect()
    for r in rows:
        a, e = set(r["fingerprint"].split()), set(r["edited_fingerprint"].split())
        assert r["near_edited"] == pytest.approx(len(a & e) / len(a | e) if a | e else 1.0)


def test_buckets_have_partitions_of_their_own(spark):
    for n in (2, 7, 51, 211):
        keys = sy.spread_keys(spark, n)
        df = spark.createDataFrame([(k,) for k in keys], "key int").repartition(n, "key").select(F.spark_partition_id().alias("p"), "key")
        assert {r["p"]: r["key"] for r in df.collect()} == dict(enumerate(keys))


def test_code_point_anchors_equal_the_definition(spark):
    k, s = sy.CHAR_K, sy.CHAR_S
    texts = ["", "short", "exactly10!", "aaaaaaaaaaaaaaaaaaaa", "one 😀 two é three 漢字漢字 and more of it, \n\n at some length"]
    for t in texts:
        mers = spark.createDataFrame([(i, *t[i:i + s]) for i in range(len(t) - s + 1)] or [(0, "", "", "")], "i int, a string, b string, c string")
        h = [r[0] for r in mers.orderBy("i").select(F.xxhash64("a", "b", "c")).collect()]
        w = k - s + 1
        want = [i for i in range(len(t) - k + 1) if min(h[i], h[i + w - 1]) == min(h[i:i + w])] if len(t) >= k else [0] * bool(t)
        got = spark.createDataFrame([(t,)], "t string").select(sy.char_anchors(F.col("t")).alias("a")).first()["a"]
        assert got["pos"] == want and len(got["hash"]) == len(want)
        grams = [t[i:i + k] for i in want]
        assert len(set(got["hash"])) == len(set(grams))


def test_the_query_finds_short_and_unspaced_kept_halves(spark, tmp_path):
    from adlens.llm.queries import op10_closed_syncmers
    rng = __import__("random").Random(3)
    unspaced = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400))
    rows = [(1, "three longish words, then some further ones here"), (2, unspaced), (3, "quite another text that goes on for a long, long while")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    near = {r["doc_id"]: r["near_edited"] for r in op10_closed_syncmers(spark, str(tmp_path)).collect()}
    assert all(v > 0.1 for v in near.values()), near
