import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlens.llm import forced_bpe, queries, tokens

SF = "/root/testdata/sf0.001"
PATH = tokens.public_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def check(tok, bpe, text):
    want = ids_of(tok, text)
    got = bpe.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == want, text
    assert bpe.decode(got) == tok.decode(want, skip_special_tokens=False)


def test_random_texts(tok):
    """Marks, apostrophes, all kinds of white space, several scripts, the added token, odd mixes."""
    rnd, bpe = random.Random(3), forced_bpe.codec(PATH)
    parts = [*"ab'st!?, \n\t\r\x0b\x1c\x85\xa0\u1680\u2009\u2028\u3000éàñß東京жд١2३9<|>’“—_-/\\\u0301👍🏽elrvmdS\x00", "'s", "'ll", " '", "<|endoftext|>",
             "  ", "\n\n", "the", " of", "İ"]
    for _ in range(20_000):
        check(tok, bpe, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))))


def test_every_character(tok):
    """Each code point between, before and after letters, spaces, marks and apostrophes."""
    bpe = forced_bpe.ForcedBoundaryBPE(PATH)
    points = [c for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 64):
        text = "".join(f"a{c}b {c} '{c}!{c}'s1{c}\n{c}{c} " for c in map(chr, points[at:at + 64]))
        check(tok, bpe, text)


def test_fragments_are_encoded_independently(tok):
    bpe = forced_bpe.codec(PATH)
    text = "It's the cat's; (see 12 of 'em)!'s\n\n  Next qXqX line — naïve"
    parts = bpe.fragments(text.encode())
    assert b"".join(parts) == text.encode() and len(parts) > 12
    assert [i for p in parts for i in ids_of(tok, p.decode())] == ids_of(tok, text)


def test_no_cut_inside_a_token(tok):
    bpe = forced_bpe.codec(PATH)
    assert all(len(bpe.fragments(t)) == 1 for t in bpe.token_bytes.values() if t)


def test_long_pieces_and_small_caches(tok):
    bpe = forced_bpe.ForcedBoundaryBPE(PATH, most=3)
    for text in ("w" * 3000 + "ab" * 2000, "=" * 700, "one two three four five six", "é" * 200):
        check(tok, bpe, text)
    assert len(bpe.kept) <= 3


def test_decode_of_any_ids(tok):
    rnd, bpe = random.Random(9), forced_bpe.codec(PATH)
    for _ in range(5_000):
        ids = [rnd.randrange(50257) for _ in range(rnd.randint(0, 6))]
        assert bpe.decode(np.array(ids, "<u4").tobytes()) == tok.decode(ids, skip_special_tokens=False)
    with pytest.raises(KeyError):
        bpe.decode(np.array([60000], "<u4").tobytes())


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        forced_bpe.ForcedBoundaryBPE(tokens.public_path("word_bpe_49k.json"))


def plain(tok, rows):
    out = []
    for doc, text in rows:
        ids = ids_of(tok, text)
        raw = np.array(ids, "<u4").tobytes()
        back = tok.decode(ids, skip_special_tokens=False)
        out.append((doc, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def test_odd_rows(spark, tok, odd_docs, no_docs):
    got = forced_bpe.digests(odd_docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(tok, [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert forced_bpe.digests(no_docs).count() == 0


def test_columns(spark, tok, odd_docs):
    rows = odd_docs.select("text", forced_bpe.encode(F.col("text")).alias("ids")).withColumn("back", forced_bpe.decode(F.col("ids"))).collect()
    for r in rows:
        assert r["ids"] == ids_of(tok, r["text"]) and r["back"] == (r["text"] or "")


def test_query(spark, tok):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.op12_forced_bpe(spark, SF).collect()), key=str) == plain(tok, rows)
