import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlens.llm import packing, tokens


def fewest(lengths, cap):
    """Exact number of sequences by search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def put(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for k in range(len(room)):
            if room[k] >= lengths[i] and room[k] not in room[:k]:
                put(i + 1, room[:k] + [room[k] - lengths[i]] + room[k + 1:])
        put(i + 1, [*room, cap - lengths[i]])

    put(0, [])
    return best


def test_bin_completion_is_valid_and_close_to_the_fewest():
    rng = random.Random(3)
    optimal = 0
    for _ in range(60):
        cap = 40
        lengths = [rng.randint(1, cap) for _ in range(rng.randint(1, 11))]
        bins = packing.bin_completion(lengths, cap)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(0 < sum(lengths[i] for i in b) <= cap for b in bins)
        n = fewest(lengths, cap)
        assert -(-sum(lengths) // cap) <= packing.fewest_bound(lengths, cap) <= n
        assert n <= len(bins) <= len(packing.best_fit(lengths, cap))
        optimal += len(bins) == n
    assert optimal >= 58


def brute_undominated(pieces, room):
    """Every filling that no other filling dominates, by definition: A dominates B if B's pieces
    can be dealt over A's, none of A's being exceeded."""
    every = {tuple(sorted(f, reverse=True)) for k in range(len(pieces) + 1) for f in itertools.combinations(pieces, k) if sum(f) <= room}

    def dominates(a, b):
        if a == b:
            return False

        def deal(i, space):
            return i == len(b) or any(space[j] >= b[i] and deal(i + 1, space[:j] + (space[j] - b[i],) + space[j + 1:]) for j in range(len(space)))

        return deal(0, a)

    return {b for b in every if not any(dominates(a, b) for a in every)}


def test_completions_are_all_the_undominated_fillings():
    rng = random.Random(8)
    for _ in range(150):
        cap = rng.choice([12, 20, 30])
        pieces = [rng.randint(1, cap) for _ in range(rng.randint(0, 8))]
        room = rng.randint(0, cap)
        found = list(packing.completions(packing._Counts(pieces, cap), room, steps=10**6))
        assert len(found) == len(set(found))
        assert set(found) == brute_undominated(pieces, room), (pieces, room)
        assert [sum(f) for f in found] == sorted((sum(f) for f in found), reverse=True)
        least = rng.randint(0, room)
        assert list(packing.completions(packing._Counts(pieces, cap), room, least, steps=10**6)) == [f for f in found if sum(f) >= least]
    c = packing._Counts([700, 650, 500, 450, 300, 250], 2048)
    assert {(700, 500), (650, 300, 250)} <= set(packing.completions(c, 1200))


def test_groups_of_awkward_pieces_come_close_to_the_bound():
    rng = random.Random(5)
    gaps = []
    for _ in range(8):
        lengths = [rng.randint(400, 1300) for _ in range(300)]
        bins = packing.bin_completion(lengths, 2048)
        assert sorted(i for b in bins for i in b) == list(range(300)) and all(sum(lengths[i] for i in b) <= 2048 for b in bins)
        assert len(bins) <= len(packing.best_fit(lengths, 2048))
        gaps.append(len(bins) - packing.fewest_bound(lengths, 2048))
    assert max(gaps) <= 3 and sum(gaps) <= 12, gaps


def test_equal_rows_reach_all_groups(spark):
    """3,000 copies of one row, 30 groups wanted: none holds much more than its share."""
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three four").alias("text"))
    rows = packing.pack(docs, tokens.public_path(), group_pieces=100)
    per = [r["count"] for r in rows.groupBy(F.shiftright("sequence_id", 32)).count().collect()]
    assert sum(per) == 3000 and len(per) == 30 and max(per) < 160
    assert packing.pack(docs.withColumn("doc_id", F.lit(None).cast("long")), tokens.public_path(), group_pieces=100).count() == 3000


def test_search_beats_best_fit_where_it_can():
    lengths = [6, 6, 5, 5, 4, 4, 3, 3, 2, 2]  # 40 tokens fill four sequences of 10
    assert len(packing.bin_completion(lengths, 10)) == 4


def test_large_group_meets_its_bound():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 2049, 4000).tolist()
    bins = packing.bin_completion(lengths, 2048)
    assert len(bins) <= packing.fewest_bound(lengths, 2048) + 8
    assert sorted(i for b in bins for i in b) == list(range(4000))


def check(rows, docs, cap, end):
    tok = Tokenizer.from_file(tokens.public_path())
    want = []
    for r in docs.collect():
        ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, end]
        for k, at in enumerate(range(0, len(ids), cap)):
            part = np.array(ids[at:at + cap], "<u4")
            want.append((r["doc_id"] is not None, r["doc_id"] or 0, k, at, len(part), zlib.crc32(part.tobytes())))
    got = [(r["doc_id"] is not None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got) == sorted(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    return len(sequences), -(-sum(r["length"] for r in rows) // cap)


def test_pack(odd_docs, no_docs, spark):
    for cap, groups in ((2048, 1 << 26), (64, 2000)):
        rows = packing.pack(odd_docs, tokens.public_path(), capacity=cap, group_tokens=groups).collect()
        used, bound = check(rows, odd_docs, cap, 0)
        assert used <= bound + max(2, sum(r["length"] for r in rows) // groups + 2)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    used, bound = check(packing.pack(docs, tokens.public_path()).collect(), docs, 2048, 0)
    assert used <= bound + 2
    assert packing.pack(no_docs, tokens.public_path()).count() == 0


def test_word_table_starts_anew_when_full():
    enc = tokens.WordEncoder(tokens.public_path(), most=5)
    tok = Tokenizer.from_file(tokens.public_path())
    for text in ["a b c d e f g h", "Hello, WORLD! it's I'LL; no.", "Straße naïve éa ŒUVRE don't 3.14", "Σίσυφος ΟΔΟΣ İ ﬃ é  x", "😀👍 a​b", None]:
        assert np.frombuffer(enc.ids(text), "<u2").tolist() == tok.encode(text or "", add_special_tokens=False).ids
