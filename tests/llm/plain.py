"""Plain Python versions of the operators' definitions, for comparison in the tests."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def simhash(text, k=3, seed=42):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, bits=2):
    """fp -> smallest reachable fp, all pairs compared."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(set(fps))
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def measures(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if n[x] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def base_failed(m):
    return m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Iterative resharing: source -> target."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(sizes.values())
    fixed = {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        left = total - sum(fixed.values())
        goal = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if goal[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **goal}
        fixed |= {s: cap * sizes[s] for s in over}


def mix(rows, seed=0):
    """rows (doc_id, text, source) -> sorted (doc_id, size, source_size, target, taken)."""
    sized = []
    for d, t, s in rows:
        md5 = hashlib.md5((t or "").encode()).hexdigest()
        key = hashlib.md5(f"{seed}:{'' if d is None else d}:{md5}".encode()).hexdigest()
        sized.append((s, key, d, len(words(t))))
    per = Counter()
    for s, _, _, n in sized:
        per[s] += n
    goal = targets(dict(per))
    out = []
    for s in per:
        budget = round(goal[s] + 1e-9) if goal[s] % 1 != 0.5 else int(goal[s] + 0.5)
        epochs = budget // per[s] if per[s] else 0
        left = budget - epochs * per[s]
        for _, key, d, n in sorted((x for x in sized if x[0] == s), key=lambda x: (x[1], x[2] is not None, x[2] or 0)):
            part = max(0, min(n, left))
            left -= part
            out.append((d, n, per[s], goal[s], epochs * n + part))
    return out


def spark_hash(*longs):
    """Spark's xxhash64 of whole numbers."""
    h = 42
    for x in longs:
        h = xxhash.xxh64_intdigest(struct.pack("<q", x), h)
    return h - (1 << 64) if h >> 63 else h


def word_hash(w):
    h = xxhash.xxh64_intdigest(w.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def syncmers(text, k=6, s=2):
    h = [word_hash(w) for w in words(text)]
    if not h:
        return []
    if len(h) < k:
        return [(0, spark_hash(*h))]
    out = []
    for i in range(len(h) - k + 1):
        inner = [spark_hash(*h[i + j:i + j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, spark_hash(*h[i:i + k])))
    return out


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]
