"""Byte-level BPE by forced-boundary splitting, and its decoding (operator 12).

A byte pair that occurs inside no vocabulary token can never be bridged by a merge, so
every place where it stands is a certain cut: the ids of a text are the ids of the
fragments between such places, one after the other. Fragments are encoded independently
(a merge loop over each of their pieces) and most of them repeat, so a worker keeps the
ids of those it has met.

The tokenizer first splits text by a pattern. A pair is used as a cut only where the
pattern reads both sides as it reads the whole, which leaves out three kinds of places:

* inside a character (the second byte continues a UTF-8 sequence);
* after white space: how a run of white space is split depends on what follows it;
* before an apostrophe, unless an ASCII letter or digit precedes: ``'s`` after another
  mark is part of that mark's run, but at a fragment's start it would be a suffix.

Everywhere else the pattern never looks behind, and looks ahead only after white space.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.tokens import _byte_letters, public_path

KEEP_FRAGMENTS = 800_000
KEEP_BYTES = 48  # longer fragments are encoded each time, not kept


class ForcedBoundaryBPE:
    """Encoder and decoder of one byte-level BPE file (tokenizers JSON, no normaliser)."""

    def __init__(self, path: str, most: int = KEEP_FRAGMENTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        if (spec["normalizer"] or split.get("type") != "ByteLevel" or not split.get("use_regex") or split.get("add_prefix_space")
                or model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix")
                or model.get("end_of_word_suffix")):
            raise ValueError("not a plain byte-level BPE file")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str  # the pattern, as the library applies it
        self.byte_of = {c: b for b, c in _byte_letters().items()}
        vocab: dict[str, int] = model["vocab"]
        self.token_bytes = {i: bytes(map(self.byte_of.__getitem__, w)) for w, i in vocab.items()}
        self.first = [vocab.get(c, -1) for _, c in sorted(_byte_letters().items())]
        if -1 in self.first or array("I", [1]).tobytes() != b"\x01\0\0\0":
            raise ValueError("a byte has no token, or ids are not little-endian here")
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.token_bytes |= {i: w.encode() for w, i in self.added.items()}
        self.cuts_after = self._certain_cuts()
        self.kept: dict[bytes, bytes] = {}
        self.most = most

    def _certain_cuts(self) -> np.ndarray:
        """65,536 flags: may a text be cut between the two bytes of this pair?"""
        cut = np.ones((256, 256), bool)
        for token in self.token_bytes.values():
            cut[list(token[:-1]), list(token[1:])] = False
        cut[:, 0x80:0xC0] = False
        gaps = {chr(c).encode()[-1] for c in range(0x3001) if chr(c).isspace()}
        cut[sorted(gaps)] = False
        word = np.zeros(256, bool)
        word[[b for b in range(128) if chr(b).isalnum()]] = True
        cut[~word, ord("'")] = False
        return cut.reshape(-1)

    def fragments(self, raw: bytes) -> list[bytes]:
        """``raw`` (UTF-8) cut at every certain place."""
        b = np.frombuffer(raw, np.uint8)
        pair = b[:-1].astype(np.uint16) << 8 | b[1:]
        at = [0, *(np.flatnonzero(self.cuts_after[pair]) + 1).tolist(), len(raw)]
        return [raw[i:j] for i, j in zip(at, at[1:])]

    def _merge(self, piece: Iterable[int]) -> list[int]:
        """Ids of one piece of the pattern: the pair of lowest rank is merged, leftmost first."""
        ids = list(map(self.first.__getitem__, piece))
        if len(ids) > 32:
            return self._merge_long(ids)
        merges, none = self.merges, (1 << 30, -1)
        steps = [merges.get(p, none) for p in zip(ids, ids[1:])]
        while steps:
            step = min(steps)
            if step is none:
                break
            i = steps.index(step)
            ids[i:i + 2] = [step[1]]
            del steps[i]
            if i:
                steps[i - 1] = merges.get((ids[i - 1], ids[i]), none)
            if i < len(steps):
                steps[i] = merges.get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for a long piece, with a heap of pairs over a linked list."""
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p][0], i, merges[p][1], *p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            rank, i, new, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (ids[x], ids[y]) in merges:
                    rank, new = merges[ids[x], ids[y]]
                    heapq.heappush(heap, (rank, x, new, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def _fragment(self, fragment: bytes) -> bytes:
        if fragment.isalpha() or (fragment[0] == 32 and fragment[1:].isalpha()):  # ASCII letters: one piece
            ids = self._merge(fragment)
        else:
            byte_of = self.byte_of
            ids = [i for piece, _ in self.pieces(fragment.decode()) for i in self._merge([byte_of[c] for c in piece])]
        out = array("I", ids).tobytes()
        if len(fragment) <= KEEP_BYTES:
            if len(self.kept) >= self.most:
                self.kept.clear()
            self.kept[fragment] = out
        return out

    def _plain(self, text: str) -> bytes:
        kept, make = self.kept.get, self._fragment
        return b"".join([kept(f) or make(f) for f in self.fragments(text.encode("utf-8", "replace"))]) if text else b""

    def encode(self, text: str | None) -> bytes:
        """The text's ids as little-endian uint32; added tokens in the text become their ids."""
        text = text or ""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self._plain(text[at:m.start()]), self.added[m.group()].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """Text of little-endian uint32 ids, added tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> ForcedBoundaryBPE:
    """One per worker process and file."""
    return ForcedBoundaryBPE(path)


def encode(text: Column, path: str | None = None) -> Column:
    """array<int> of the ids of a text column; a null text gives an empty array."""
    path = path or public_path("byte_bpe_50k.json")

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        bpe = codec(path)
        return pd.Series([np.frombuffer(bpe.encode(t), "<i4") for t in texts], dtype=object)

    return ids(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """Text of an ids column (array<int>); a null array stays null, an unknown id raises."""
    path = path or public_path("byte_bpe_50k.json")

    @F.pandas_udf("string")
    def text(arrays: pd.Series) -> pd.Series:
        bpe = codec(path)
        return pd.Series([None if a is None else bpe.decode(np.asarray(a, "<u4").tobytes()) for a in arrays], dtype=object)

    return text(ids)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs`` (doc_id, text).

    Whole texts are encoded and their ids decoded again, in one pass over the rows and
    without a shuffle. A null text counts as empty (no ids); repeated rows give equal rows;
    a null doc_id stays null; extra columns are not carried; an empty table gives no rows.
    """
    path = path or public_path("byte_bpe_50k.json")

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        bpe = codec(path)
        rows = []
        for t in texts:
            ids = bpe.encode(t)
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digest("text").alias("d")).select("doc_id", "d.*")
