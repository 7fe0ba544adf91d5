"""Best-fit packing by bin completion branch-and-bound (operator 4).

Texts become token ids, each text closed by an end id; only longer ones are cut, into
pieces of the sequence length. Pieces are dealt at random over groups of up to
``group_tokens`` tokens, so a group is bounded however large the corpus is, and each
group is packed by bin completion: the largest piece left opens a sequence; the
undominated ways to fill it from the other pieces are enumerated, fullest first, as far
as the waste they make still leaves fewer sequences than the incumbent has. The first
incumbent is the best-fit-decreasing solution. The search ends when the incumbent meets a
lower bound on the sequences, when a round has left nothing out, or after trying
``extra_nodes`` sequences beyond those of one whole solution, with the best one so far.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import partitions, staged
from adlens.llm.tokens import encoder

# doc_id travels as text through pandas, which would turn a column with nulls into floats.
PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                raw = enc.ids(text) + end_id.to_bytes(2, "little")
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    out.append((doc, k, at, len(part), zlib.crc32(part.tobytes())))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, PIECES)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit-decreasing: sequences as lists of positions in ``lengths``."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (space left, sequence), sorted
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(room, (lengths[i], -1))
        if at < len(room):
            left, b = room.pop(at)
            bins[b].append(i)
        else:
            left, b = capacity, len(bins)
            bins.append([i])
        if left > lengths[i]:
            insort(room, (left - lengths[i], b))
    return bins


def fewest_bound(lengths: list[int], capacity: int) -> int:
    """Sequences that any packing needs: over all k, pieces over capacity - k share no
    sequence with pieces of k or more, those over half share none with each other, and
    what is left of the latter must take the pieces from k to half the capacity."""
    n = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = n * np.arange(capacity + 1)
    count, total = np.concatenate(([0], np.cumsum(n))), np.concatenate(([0], np.cumsum(size)))  # of lengths below x
    half = capacity // 2
    k = np.arange(0, half + 1)
    alone = count[-1] - count[capacity - k + 1]
    middle = count[capacity - k + 1] - count[half + 1]
    room = middle * capacity - (total[capacity - k + 1] - total[half + 1])
    small = total[half + 1] - total[k]
    return int((alone + middle + np.maximum(0, -((room - small) // capacity))).max())


class _Counts:
    """How many pieces of each length are left; the lengths in use as bits of one number, also
    mirrored, so that all pairs of a given sum are one shift and one conjunction."""

    def __init__(self, lengths: list[int], capacity: int):
        self.capacity, self.n = capacity, [0] * (capacity + 1)
        self.used = self.mirror = 0
        self.add(lengths, 1)

    def add(self, fill, by: int) -> None:
        for x in fill:
            self.n[x] += by
            if self.n[x] == (1 if by > 0 else 0):
                self.used ^= 1 << x
                self.mirror ^= 1 << (self.capacity - x)

    def largest(self, most: int) -> int:
        return max(0, (self.used & ((2 << most) - 1)).bit_length() - 1)

    def smallest(self) -> int:
        return (self.used & -self.used).bit_length() - 1

    def pairs(self, total: int) -> int:
        """Bits x such that pieces x and total - x are there."""
        return self.used & (self.mirror >> (self.capacity - total))


def _downwards(bits: int, lowest: int) -> Iterator[int]:
    """Places of set bits from the highest down to ``lowest``."""
    while bits >> lowest:
        x = bits.bit_length() - 1
        yield x
        bits ^= 1 << x


def _exactly(c: _Counts, total: int, k: int, most: int, taken: tuple[int, ...], steps: list[int]) -> Iterator[tuple[int, ...]]:
    """Every multiset of ``k`` pieces of at most ``most`` that sum to ``total``, beside ``taken``;
    largest pieces first. ``steps`` counts lookups and findings down; at zero the rest is left out."""
    free = lambda x, more=(): c.n[x] > taken.count(x) + more.count(x)
    if k == 1:
        if 0 < total <= most and free(total):
            yield (*taken, total)
        return
    if total > 0 and k == 2:
        steps[0] -= 1
        for x in _downwards(c.pairs(total) & ((2 << min(most, total)) - 1), -(-total // 2)):
            if steps[0] <= 0:
                return
            if free(x) and free(total - x, (x,)):
                steps[0] -= 1
                yield (*taken, x, total - x)
        return
    high = min(most, total - (k - 1) * c.smallest())
    if high > 0:
        for x in _downwards(c.used & ((2 << high) - 1), max(1, -(-total // k))):
            if steps[0] <= 0:
                return
            steps[0] -= 1
            if free(x):
                yield from _exactly(c, total - x, k - 1, x, (*taken, x), steps)


def dominated(c: _Counts, fill: tuple[int, ...], slack: int) -> bool:
    """Could some pieces of ``fill`` (or none) be replaced by one left-over piece that is larger and
    still fits, or by one as large as two or more of them? Then what ``fill`` would leave
    for later can be exchanged for it: another filling is at least as good. A filling that
    another one dominates piece by piece always has such a single replacement."""
    one = two = 0  # sums of single pieces, of two or more
    left = c.used
    for x in fill:
        two |= (two | one) << x
        one |= 1 << x
        if c.n[x] == fill.count(x):
            left &= ~(1 << x)
    if two & left:
        return True
    larger, width = (1 | one | two) << 1, 1
    while width < slack:  # larger by 1 to slack
        step = min(width, slack - width)
        larger |= larger << step
        width += step
    return bool(slack and larger & left)


def completions(c: _Counts, room: int, least: int = 0, steps: int = 24) -> Iterator[tuple[int, ...]]:
    """All undominated ways to fill ``room`` with at least ``least`` (the waste bound), one at a
    time: fullest first, then fewest pieces, then largest pieces.

    After ``steps`` lookups the listing ends; if it has nothing by then, it gives the filling
    that takes an exact pair or else the largest piece that fits, again and again. Sets of some hundred lengths
    without an exact filling meet that limit, small ones are listed whole.
    """
    small = c.smallest()
    if room <= 0 or not c.used or small > room:
        if least <= 0:
            yield ()
        return
    top, budget, some = c.largest(room), [steps], False
    for total in range(room if room >= 2 * small else top, max(least, small) - 1, -1):
        for k in range(max(1, -(-total // top)), total // small + 1):
            for fill in _exactly(c, total, k, top, (), budget):
                if not dominated(c, fill, room - total):
                    some = True
                    yield fill
            if k == 1 and total == room and c.n[room]:
                return  # a single piece that fits exactly dominates everything else
            if budget[0] <= 0:
                break
        if budget[0] <= 0:
            break
    if not some and budget[0] <= 0:
        fill: list[int] = []
        left = room
        while left > 0 and (x := c.largest(left)):
            exact = c.pairs(left) & ((1 << left) - 1)
            if x < left and exact:
                y = exact.bit_length() - 1
                if 2 * y != left or c.n[y] > 1:
                    x = y  # its partner fills the rest exactly
            fill.append(x)
            c.add((x,), -1)
            left -= x
        c.add(fill, 1)
        if room - left >= least:
            yield tuple(fill)


def bin_completion(lengths: list[int], capacity: int, extra_nodes: int = 20_000) -> list[list[int]]:
    """Pack ``lengths`` (1 to ``capacity`` each) into few sequences; positions per sequence.

    The search goes by limited discrepancy: taking the j-th filling of a sequence costs j,
    and rounds allow a sum of 0, 1, 2, ... over a whole solution, spent on early sequences
    first. A round that left nothing out proves the best solution to be the fewest.
    """
    if not lengths:
        return []
    incumbent = best_fit(lengths, capacity)
    bound = fewest_bound(lengths, capacity)
    best: list[tuple[int, ...]] | None = None
    best_n, total = len(incumbent), int(sum(lengths))
    counts = _Counts(lengths, capacity)
    nodes_left = len(incumbent) + extra_nodes
    limit, left_out = 0, best_n > bound
    while left_out and best_n > bound and nodes_left > 0:
        left_out, waste = False, 0
        path: list[tuple[int, ...]] = []
        stack: list[tuple[list[tuple[int, tuple[int, ...]]]]] = []

        def open_next(allowed: int) -> None:
            nonlocal left_out
            a = counts.largest(capacity)
            counts.add((a,), -1)
            # a solution that beats the best wastes at most this much in all
            spare = (best_n - 1) * capacity - total - waste
            fills = list(islice(completions(counts, capacity - a, capacity - a - spare), allowed + 1))
            counts.add((a,), 1)
            left_out |= len(fills) > allowed  # there may be more
            stack.append([(allowed - j, (a, *f)) for j, f in enumerate(fills)])  # the last is tried first

        open_next(limit)
        while stack and best_n > bound and nodes_left > 0:
            if not stack[-1]:
                stack.pop()
                if path:
                    back = path.pop()
                    counts.add(back, 1)
                    waste -= capacity - sum(back)
                continue
            allowed, seq = stack[-1].pop()
            nodes_left -= 1
            lost = capacity - sum(seq)
            if waste + lost > (best_n - 1) * capacity - total:
                continue  # the best has improved since this one was listed
            counts.add(seq, -1)
            if counts.used:
                path.append(seq)
                waste += lost
                open_next(allowed)
            else:
                best, best_n = [*path, seq], len(path) + 1
                counts.add(seq, 1)
        for seq in path:
            counts.add(seq, 1)
        limit += 1
    if best is None:
        return incumbent
    by_length: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        by_length.setdefault(lengths[i], []).append(i)
    return [[by_length[x].pop() for x in seq] for seq in best]


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
         group_tokens: int = 1 << 26, group_pieces: int = 1 << 17, extra_nodes: int = 20_000) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    A null or empty text is its end id alone; repeated rows are packed as rows of their
    own; a null doc_id stays null; extra columns are not carried; an empty table gives no
    rows. Where the search meets the bound of a group, the group wastes less than one
    sequence, so dealing the pieces over groups costs at most one sequence each.
    """
    rows = staged(pieces(docs, tokenizer, capacity, end_id), "pieces")
    tokens, count = rows.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    n = max(1, -(-tokens // group_tokens), -(-count // group_pieces))
    # The place of a row in the staged files deals rows that are equal over all groups.
    place = ["_metadata.file_name", "_metadata.row_index"]
    dealt = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "piece", "start", "length", "ids_crc32",
                        F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", *place), F.lit(n)).alias("deal"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                                  kind="stable").reset_index(drop=True)
        lengths = group["length"].tolist()
        seq, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for s, members in enumerate(bin_completion(lengths, capacity, extra_nodes)):
            at = 0
            for i in members:
                seq[i], offset[i] = s, at
                at += lengths[i]
        first = int(group["deal"].iloc[0]) << 32
        return group.drop(columns="deal").assign(sequence_id=seq + first, offset=offset)

    # A fixed number of partitions: adaptive execution would merge groups into one task.
    dealt = dealt.repartition(max(1, min(n, partitions(docs.sparkSession))), "deal")
    packed = dealt.groupBy("deal").applyInPandas(run, PIECES + ", sequence_id long, offset long")
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))
