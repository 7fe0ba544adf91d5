import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from adlens.llm import queries, spelling

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-z\u00C0-\u00FF]+")


def edits(word, letters):
    cut = {word[:i] + word[i + 1:] for i in range(len(word))}
    put = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    swap = {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    return (cut | put | swap) - {word}


def plain_vocab(rows, shortest=5, least=3, one_in=97):
    n = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            crc = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if one_in and crc % one_in == 0:
                run = run[:crc % len(run)] + run[crc % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= least}


def plain_forms(vocab, ratio=2):
    letters = {c for w in vocab for c in w}
    near = {w: edits(w, letters) & vocab.keys() for w in vocab}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best is not None and vocab[best] >= ratio * vocab[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), vocab[w], len(near[w]), vocab.get(form[w])) for w in vocab)


def rows_of(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_bloom_spelling(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_forms(plain_vocab(rows))
    assert rows_of(got) == want
    assert sum(r[1] != "" for r in want) > 20


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("row", "word").withColumnRenamed("size", "n")
    for least, one_in in ((1, None), (1, 2), (3, 97)):
        got = spelling.variants(docs, least=least, one_in=one_in)
        assert rows_of(got) == plain_forms(plain_vocab([(r["doc_id"], r["text"]) for r in odd_docs.collect()], least=least, one_in=one_in))
    assert spelling.variants(no_docs).count() == 0


@pytest.fixture(scope="module")
def vocab():
    """Dense words over few letters, long words around the shared shard, letters beyond ASCII."""
    rnd = random.Random(4)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 8))) for _ in range(500)}
    long = ["".join(rnd.choice("xyzþ") for _ in range(n)) for n in (62, 63, 64, 65, 66, 300)]
    words |= {w for x in long for w in (x, x[:-1], "q" + x, x[:5] + "w" + x[6:])}
    words |= {"東京都庁", "東京都廰", "東京都"}
    return {w: rnd.choice([1, 1, 2, 3, 5, 8, 20, 50, 200]) for w in sorted(words)}


@pytest.mark.parametrize("filter_bytes", [16 << 20, 256, 8])
def test_vocabulary(spark, vocab, filter_bytes):
    """One wave, several waves, and lengths split over several filters give the same links."""
    got = spelling.forms(spark.createDataFrame(list(vocab.items()), "word string, n long"), filter_bytes=filter_bytes)
    assert rows_of(got) == plain_forms(vocab)


def test_near_pairs_both_ways_once(spark, vocab):
    got = [(r["word"], r["near"]) for r in spelling.near_words(spark.createDataFrame(list(vocab.items()), "word string, n long")).collect()]
    letters = {c for w in vocab for c in w}
    assert sorted(got) == sorted((w, x) for w in vocab for x in edits(w, letters) & vocab.keys())


def test_long_chains(spark):
    """A chain of 70 forms, and a word that many others lead to."""
    chain = {"a" * (5 + k): 2 ** k for k in range(60)}
    rows = spark.createDataFrame([(w, "a" * (len(w) + 1) if len(w) < 64 else None) for w in chain], "word string, form string")
    got = {r["word"]: r["root"] for r in spelling.roots(rows).collect()}
    assert got == {w: "a" * 64 for w in chain if len(w) < 64}


def test_edit_hashes():
    rnd = random.Random(1)
    for length in (1, 2, 7, 70):
        words = ["".join(rnd.choice("abcé東") for _ in range(length)) for _ in range(20)]
        found = spelling.deletion_hashes(spelling.codes_of(words, length))
        for k, w in enumerate(words):
            for i in range(length):
                cut = w[:i] + w[i + 1:]
                want = spelling.word_hashes(spelling.codes_of([cut], length - 1))[0] if cut else 0
                assert found[k, i] == want


def test_filters_have_few_false_positives():
    rnd = np.random.default_rng(2)
    shards = spelling.Shards({8: 20_000})
    h = rnd.integers(0, 2**63, 120_000).astype(np.uint64)
    blocks = np.zeros(shards.blocks[8], np.uint64)
    _, block, bits = shards.places(h[:20_000], 8)
    np.bitwise_or.at(blocks, block, bits)
    assert len(spelling._lookup(shards, {(8, 0): blocks}, h[:20_000], 8)) == 20_000
    assert len(spelling._lookup(shards, {(8, 0): blocks}, h[20_000:], 8)) < 500
