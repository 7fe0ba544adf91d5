"""Spelling variants by Bloom-guided neighbourhoods (operator 11).

Two words are near if one inserted, deleted or replaced code point makes one the other.
Every word's edits are generated where the word lies, as hashes only, and looked up in
broadcast Bloom filters of the vocabulary, one shard per word length. Few edits are found
there; only those become strings, shuffle to an exact join with the vocabulary, and lose
their false positives. Nearness is mutual, so deletions and replacements by a later letter
are enough: an insertion is the other word's deletion.

* **Blocked filters.** A word sets 5 bits of one 64-bit block, 24 bits per word. One lookup is
  one memory access.
* **Bounded broadcasts.** Shards travel in waves of at most ``filter_bytes``; a length too
  large for that is split by hash. A vocabulary of any size takes as many waves as it needs
  and gives the same result.
* **Rolling hashes.** A word's hash is a polynomial over its code points, so the hash of
  each edit follows from prefix and suffix sums; a word of any length costs its edits, not
  its edits times its length.
* **Partners.** A word has at most as many near words as it has edits; none is dropped.

A word's form is its near word with the largest count, if that is at least ``ratio`` times
its own; counts grow along forms, so following them ends. Roots are found by pointer
doubling, a join per round, over logarithmically many rounds.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import partitions, staged

BITS_PER_WORD = 24
BITS_SET = 5
FILTER_BYTES = 16 << 20
LONG = 64  # longer words share one shard
HELD_WORDS = 400_000  # counts a task holds before it hands them on
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_U = np.uint64


def damaged(run: bytes, doc_crc: int, one_in: int) -> bytes:
    """``run`` (Latin-1), without one letter where ``one_in`` divides crc32(`<doc_id>:<run>`)."""
    crc = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), doc_crc)
    if crc % one_in:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, one_in: int | None = None) -> DataFrame:
    """(word, n): words of at least ``shortest`` letters that occur ``least`` times or more in
    the whole texts of ``docs`` (doc_id, text).

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. With
    ``one_in`` a fixed part of the runs loses a letter first (:func:`damaged`); a null doc_id
    counts as an empty one there. Tasks hand on counts, not words. Null and empty texts have no
    words; repeated rows count each time; extra columns are not carried; an empty table gives
    no rows.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, int] = {}

        def rows() -> pd.DataFrame:
            return pd.DataFrame({"word": [w.decode("latin-1") for w in held], "n": list(held.values())})

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                # Latin-1 keeps every letter of a word and turns all later characters into marks.
                found = Counter((text or "").encode("latin-1", "replace").translate(_LETTERS).split())
                crc = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in found.items():
                    if len(word) < shortest:
                        continue
                    if one_in:
                        word = damaged(word, crc, one_in)
                        if len(word) < shortest:
                            continue
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    parts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# Hashes of words and of their edits.

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


def _values(codes: np.ndarray) -> np.ndarray:
    return _mix((codes.astype(np.uint64) + _U(1)) * _U(0xD6E8FEB86659FD93))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, 0xA24BAED4963EE407, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def codes_of(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, one row per word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    return (_values(codes) * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def deletion_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of each word without its i-th letter, one column per i."""
    v, p = _values(codes), _powers(codes.shape[1])
    before = np.cumsum(v * p, axis=1, dtype=np.uint64) - v * p
    moved = v[:, 1:] * p[:-1]  # letters after the gap stand one place earlier
    after = np.zeros_like(v)
    after[:, :-1] = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    return before + after


class Shards:
    """How words are dealt over filters: ``parts`` per length, each with its number of blocks."""

    def __init__(self, counts: dict[int, int], filter_bytes: int = FILTER_BYTES):
        most = max(1, filter_bytes // 8)
        self.parts, self.blocks = {}, {}
        for length, n in counts.items():
            blocks = -(-n * BITS_PER_WORD // 64)
            self.parts[length] = -(-blocks // most)
            self.blocks[length] = -(-blocks // self.parts[length])
        self.waves: list[list[tuple[int, int]]] = []
        room = 0
        for shard in ((x, k) for x in sorted(counts) for k in range(self.parts[x])):
            if self.blocks[shard[0]] > room:
                self.waves.append([])
                room = most
            self.waves[-1].append(shard)
            room -= self.blocks[shard[0]]

    def places(self, h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(part, block, bits) of hashes of words of ``length``."""
        x = _mix(h * _U(0xFF51AFD7ED558CCD))
        y = _mix(x ^ _U(0x2545F4914F6CDD1D))
        part = (x & _U(0xFFFF)) % _U(self.parts[length])
        block = ((x >> _U(32)) * _U(self.blocks[length])) >> _U(32)
        bits = _U(1) << (y & _U(63))
        for k in range(1, BITS_SET):
            bits |= _U(1) << ((y >> _U(6 * k)) & _U(63))
        return part, block, bits


def _lookup(shards: Shards, filters: dict[tuple[int, int], np.ndarray], h: np.ndarray, length: int) -> np.ndarray:
    """Positions of hashes that the filters at hand may hold."""
    part, block, bits = shards.places(h, length)
    if shards.parts[length] == 1:
        return np.flatnonzero(filters[length, 0][block] & bits == bits)
    found = []
    for k in range(shards.parts[length]):
        if (length, k) in filters:
            at = np.flatnonzero(part == k)
            found.append(at[filters[length, k][block[at]] & bits[at] == bits[at]])
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def edits_found(words: list[str], shards: Shards, filters: dict[tuple[int, int], np.ndarray],
                letters: list[int]) -> Iterator[tuple[int, str]]:
    """(number of the word, edit) of deletions and later-letter replacements, all of one
    length, that the filters may hold."""
    length = len(words[0])
    here, shorter = min(length, LONG), min(length - 1, LONG)
    at_hand = {x for x, _ in filters}
    codes = codes_of(words, length)
    if shorter in at_hand:
        for at in _lookup(shards, filters, deletion_hashes(codes).ravel(), shorter).tolist():
            k, i = divmod(at, length)
            if not i or words[k][i] != words[k][i - 1]:  # a run of equal letters gives one edit
                yield k, words[k][:i] + words[k][i + 1:]
    if here in at_hand:
        powers = np.tile(_powers(length), len(words))
        flat = codes.ravel()
        rest = np.repeat(word_hashes(codes), length) - _values(flat) * powers
        values = _values(np.array(letters, np.uint32))
        for letter, value in zip(letters, values):
            less = np.flatnonzero(flat < letter)
            hits = less[_lookup(shards, filters, rest[less] + value * powers[less], here)]
            for at in hits.tolist():
                k, i = divmod(at, length)
                yield k, words[k][:i] + chr(letter) + words[k][i + 1:]


def _by_length(words: list[str], most: int = 1 << 18) -> Iterator[list[int]]:
    """Numbers of words of one length, at most ``most`` letters (one word at least) at a time."""
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        groups.setdefault(len(w), []).append(k)
    for length, ks in groups.items():
        step = max(1, most // max(1, length))
        for at in range(0, len(ks), step):
            yield ks[at:at + step]


def _filters(vocab: DataFrame, shards: Shards, wave: list[tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """The wave's filters. Tasks give (shard, block, bits), blocks are merged by a partial
    ``bit_or``, and the driver receives at most ``filter_bytes / 8`` blocks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["word"].tolist()
            for ks in _by_length(words):
                some = [words[k] for k in ks]
                length = min(len(some[0]), LONG)
                part, block, bits = shards.places(word_hashes(codes_of(some, len(some[0]))), length)
                yield pd.DataFrame({"length": length, "part": part.astype(np.int32), "block": block.astype(np.int64), "bits": bits.view(np.int64)})

    lengths = sorted({x for x, _ in wave})
    named = F.least(F.char_length("word"), F.lit(LONG))
    cells = vocab.filter(named.isin(lengths)).select("word").mapInPandas(run, "length int, part int, block long, bits long")
    chosen = vocab.sparkSession.createDataFrame(wave, "length int, part int")
    cells = cells.join(F.broadcast(chosen), ["length", "part"])  # one row per shard of a wave
    found = cells.groupBy("length", "part", "block").agg(F.bit_or("bits").alias("bits")).toArrow()
    length, part, block, bits = (found[c].to_numpy() for c in ("length", "part", "block", "bits"))
    out = {}
    for x, k in wave:
        mine = (length == x) & (part == k)
        out[x, k] = np.zeros(shards.blocks[x], np.uint64)
        out[x, k][block[mine]] = bits[mine].view(np.uint64)
    return out


def near_words(vocab: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): every pair of near words of ``vocab`` (word, n), both ways.

    Words are distinct and not null or empty. An empty vocabulary gives no rows.
    """
    spark = vocab.sparkSession
    pairs = "word string, n long, near string"
    size = F.least(F.char_length("word"), F.lit(LONG)).alias("length")
    counts = {r["length"]: r["count"] for r in vocab.groupBy(size).count().collect()}  # at most LONG rows
    letters = [ord(r[0]) for r in vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct().collect()]
    letters.sort()
    shards = Shards(counts, filter_bytes)
    spread = staged(vocab.select("word", "n").repartition(partitions(spark), "word"), "spelling-words")
    found = spark.createDataFrame([], pairs)
    for wave in shards.waves:
        shared = spark.sparkContext.broadcast(_filters(spread, shards, wave))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            filters = shared.value
            for batch in batches:
                words, n = batch["word"].tolist(), batch["n"].tolist()
                for ks in _by_length(words):
                    rows = [(words[ks[k]], n[ks[k]], edit) for k, edit in edits_found([words[k] for k in ks], shards, filters, letters)]
                    yield pd.DataFrame(rows, columns=["word", "n", "near"])

        reach = {x for length, _ in wave for x in (length, min(length + 1, LONG))}
        probed = spread.filter(F.least(F.char_length("word"), F.lit(LONG)).isin(sorted(reach))).mapInPandas(run, pairs)
        found = found.unionByName(staged(probed, "spelling-found"))
        shared.unpersist()
    exact = found.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("merge"), "near")
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"),
                             F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return exact.select(both.alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form) that has a form: where its forms end.

    Forms have no cycles. Each round doubles the steps taken; a word whose target has no
    form is done and leaves the rounds.
    """
    active = staged(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-forms")
    jump, done = active, None
    while True:
        onward = jump.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        moved = staged(active.join(onward.hint("merge"), F.col("root") == F.col("at"), "left")
                       .select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("open")), "spelling-roots")
        ended = moved.filter("NOT open").select("word", "root")
        done = ended if done is None else done.unionByName(ended)
        active = moved.filter("open").select("word", "root")
        if active.isEmpty():
            return done
        jump = done.unionByName(active)


def forms(vocab: DataFrame, ratio: int = 2, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of ``vocab`` (word, n).

    Ties of the largest count go to the smallest word in code-point order. A word without a
    form is its own root.
    """
    near = near_words(vocab, filter_bytes).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("best"))).alias("best"))
    named = F.col("best.less") <= -ratio * F.col("n")
    judged = staged(vocab.join(near.hint("merge"), "word", "left").select(
        "word", F.when(named, F.col("best.best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(named, -F.col("best.less")).alias("form_n")), "spelling-judged")
    return (judged.join(roots(judged).hint("merge"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def variants(docs: DataFrame, shortest: int = 5, least: int = 3, one_in: int | None = None, ratio: int = 2,
             filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """:func:`forms` of the words of ``docs`` (doc_id, text), counted by :func:`word_counts`."""
    return forms(staged(word_counts(docs, shortest, least, one_in), "spelling-vocab"), ratio, filter_bytes)
