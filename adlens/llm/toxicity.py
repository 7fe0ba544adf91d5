"""Toxicity scores by a bidirectional gated recurrent network with attention (operator 7).

Input per word: an embedding of the word (hashed) beside the mean embedding of its byte
trigrams (the character input, which also reads unknown words). Two gated recurrent
layers run over a window of words, one in each direction; attention weighs their states
into one vector; a logistic unit turns it into the window's logit. Gates and states use
x / (1 + |x|), which numpy computes some seven times faster than tanh. All of it is numpy,
trained with Adam on gradients written out by hand.

A text is scored on all its overlapping windows: one starts at every word. Neighbouring
windows read the same input one place further, so a pass over all windows of a stretch of
words works on shifted views of one array. Labels are per text, so training alternates, on
every sixth window of its sample: windows of toxic texts count as toxic
at first, later only each text's strongest window and those already above an even chance;
clean texts give their strongest windows and random others. A logistic curve of the
largest window logit, the sum of the windows' probabilities and the number of windows,
fitted on texts kept out of training, gives the score.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.nbsvm import held_out, sample

WINDOW = 12
TRAIN_STRIDE = 6
_TRIM = b".,;:!?\"'()[]{}*#%$&|<>-_"
_FLOOR = -12.0  # evidence of a text without words


@dataclass(frozen=True)
class Shape:
    words: int = 1 << 14
    grams: int = 1 << 13
    word_dim: int = 8
    char_dim: int = 8
    hidden: int = 6


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def word_codes(words: list[bytes], shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word places, trigram places of all words, where each word's trigrams start)."""
    cut = [w.strip(_TRIM) or w for w in words]
    ids = np.fromiter((zlib.crc32(w) & (shape.words - 1) for w in cut), np.int64, len(cut))
    lens = np.fromiter(map(len, cut), np.int64, len(cut))
    raw = np.frombuffer(b"^" + b"$^".join(cut) + b"$", np.uint8).astype(np.uint32)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    code = ((code * np.uint32(0x9E3779B1)) >> np.uint32(8)) & np.uint32(shape.grams - 1)
    first = np.cumsum(lens + 2) - (lens + 2)  # place of each word's ^
    keep = np.ones(len(code), bool)  # trigrams that cross from one word into the next go
    over = first[1:]
    keep[over - 1] = False
    keep[over - 2] = False
    starts = np.cumsum(lens) - lens  # a word of n bytes has n trigrams
    return ids, code[keep].astype(np.int64), starts


def squash(x: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """x / (1 + |x|), between -1 and 1; its slope is (1 - |value|)**2."""
    below = np.abs(x)
    below += 1.0
    return np.divide(x, below, out=out)


def gate_slope(gate: np.ndarray) -> np.ndarray:
    """Slope of a gate (1 + squash(x)) / 2, from its value."""
    return 0.5 * (1 - np.abs(2 * gate - 1)) ** 2


class Network:
    """Parameters by name and the passes over batches of windows."""

    def __init__(self, shape: Shape = Shape(), seed: int = 5, params: dict[str, np.ndarray] | None = None):
        self.shape = shape
        d, h = shape.word_dim + shape.char_dim, shape.hidden
        rng = np.random.default_rng(seed)
        draw = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        self.p = params or {
            "words": draw(shape.words, shape.word_dim, scale=0.1), "grams": draw(shape.grams, shape.char_dim, scale=0.3),
            "wx0": draw(d, 3 * h, scale=d**-0.5), "wx1": draw(d, 3 * h, scale=d**-0.5),
            "wh0": draw(h, 3 * h, scale=h**-0.5), "wh1": draw(h, 3 * h, scale=h**-0.5),
            "b0": np.zeros(3 * h, np.float32), "b1": np.zeros(3 * h, np.float32),
            "att": draw(2 * h, 2 * h, scale=(2 * h)**-0.5), "att_v": draw(2 * h, scale=(2 * h)**-0.5),
            "out": draw(2 * h, scale=(2 * h)**-0.5), "bias": np.zeros(1, np.float32)}

    def word_vectors(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        ids, grams, starts = word_codes(words, self.shape)
        counts = np.diff(np.append(starts, len(grams)))[:, None]
        chars = np.add.reduceat(self.p["grams"][grams], starts, axis=0) / counts.astype(np.float32)
        return np.hstack([self.p["words"][ids], chars]), (ids, grams, starts, counts)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Input part of the gates of both directions, per word."""
        return np.hstack([vectors @ self.p["wx0"] + self.p["b0"], vectors @ self.p["wx1"] + self.p["b1"]])

    def run(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Window logits of input gates (places, windows, 6h) and mask (places, windows).

        Inside, windows are the last axis: every gate is one contiguous block.
        """
        h = self.shape.hidden
        t, n, _ = gates.shape
        x = np.empty((t, 6 * h, n), gates.dtype)
        for k in range(t):
            x[k] = gates[k].T
        m = mask
        whole = bool(m.all())
        states = np.empty((t, 2 * h, n), x.dtype)
        trace = []
        for side in (0, 1):
            wh, s = np.ascontiguousarray(self.p[f"wh{side}"].T), np.zeros((h, n), x.dtype)
            for k in range(t) if side == 0 else range(t - 1, -1, -1):
                own = x[k, 3 * h * side:3 * h * (side + 1)]
                g = wh @ s
                zr = own[:2 * h] + g[:2 * h]
                squash(zr, out=zr)
                zr += 1.0
                zr *= 0.5
                z, r = zr[:h], zr[h:]
                c = r * g[2 * h:]
                c += own[2 * h:]
                squash(c, out=c)
                if keep:
                    trace.append((side, k, s, z, r, c, g[2 * h:]))
                new = s - c
                new *= z
                new += c
                if not whole:
                    new = np.where(m[k] > 0, new, s)
                s = new
                states[k, h * side:h * (side + 1)] = s
        a = squash(np.matmul(self.p["att"].T, states))
        e = np.where(m > 0, np.matmul(self.p["att_v"], a), -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tn,thn->hn", w, states)
        logit = self.p["out"] @ pooled + self.p["bias"][0]
        return (logit, (states, a, w, pooled, trace, m)) if keep else logit

    def slide(self, gates: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """Logits of all windows of a stretch of words, from its input gates (6h, words): the
        same sums as :meth:`run`, on shifted views and in place."""
        h, n = self.shape.hidden, gates.shape[1] - window + 1
        states = np.empty((window, 2 * h, n), np.float32)
        zr, c, g = (np.empty((rows, n), np.float32) for rows in (2 * h, h, 3 * h))
        for side in (0, 1):
            own, part = gates[3 * h * side:3 * h * (side + 1)], slice(h * side, h * (side + 1))
            wh = np.ascontiguousarray(self.p[f"wh{side}"].T)
            before = None
            for k in range(window) if side == 0 else range(window - 1, -1, -1):
                x, new = own[:, k:k + n], states[k, part]
                if before is None:  # the state before a window is zero
                    squash(x[:h], out=zr[:h])
                    squash(x[2 * h:], out=c)
                    np.subtract(1.0, zr[:h], out=new)
                    new *= 0.5
                    new *= c
                else:
                    np.matmul(wh, before, out=g)
                    np.add(x[:2 * h], g[:2 * h], out=zr)
                    squash(zr, out=zr)
                    zr += 1.0
                    zr *= 0.5
                    np.multiply(zr[h:], g[2 * h:], out=c)
                    c += x[2 * h:]
                    squash(c, out=c)
                    np.subtract(before, c, out=new)
                    new *= zr[:h]
                    new += c
                before = new
        a = np.matmul(np.ascontiguousarray(self.p["att"].T), states)
        e = np.matmul(self.p["att_v"], squash(a, out=a))
        e -= e.max(axis=0)
        np.exp(e, out=e)
        value = np.matmul(self.p["out"], states)
        value *= e
        return value.sum(axis=0) / e.sum(axis=0) + self.p["bias"][0]

    def gradients(self, gates: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """(loss, gradients of parameters behind the gates, gradient of the gates) of weighted log loss."""
        h = self.shape.hidden
        logit, (states, a, w, pooled, trace, m) = self.run(gates, mask, keep=True)
        prob = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        loss = float(-(weight * (y * np.log(prob + 1e-9) + (1 - y) * np.log(1 - prob + 1e-9))).sum())
        dl = (weight * (prob - y)).astype(gates.dtype)
        g = {"out": pooled @ dl, "bias": np.array([dl.sum()], gates.dtype)}
        dpool = self.p["out"][:, None] * dl
        dw = np.einsum("hn,thn->tn", dpool, states)
        ds = w[:, None, :] * dpool
        de = w * (dw - (w * dw).sum(axis=0))
        g["att_v"] = np.einsum("tn,thn->h", de, a)
        da = de[:, None, :] * self.p["att_v"][:, None] * (1 - np.abs(a)) ** 2
        g["att"] = np.einsum("tin,tjn->ij", states, da, optimize=True)
        ds = ds + np.matmul(self.p["att"], da)
        dgates = np.zeros((gates.shape[0], gates.shape[2], gates.shape[1]), gates.dtype)
        carry = [np.zeros((h, len(y)), gates.dtype) for _ in (0, 1)]
        g["wh0"], g["wh1"] = np.zeros_like(self.p["wh0"]), np.zeros_like(self.p["wh1"])
        for side, k, s, z, r, c, gn in reversed(trace):
            dh = carry[side] + ds[k, h * side:h * (side + 1)]
            on = dh * m[k]
            dc = on * (1 - z) * (1 - np.abs(c)) ** 2
            dz = on * (s - c) * gate_slope(z)
            dr = dc * gn * gate_slope(r)
            back = np.concatenate([dz, dr, dc * r])
            g[f"wh{side}"] += s @ back.T
            dgates[k, 3 * h * side:3 * h * (side + 1)] = np.concatenate([dz, dr, dc])
            carry[side] = on * z + dh * (1 - m[k]) + self.p[f"wh{side}"] @ back
        return loss, g, dgates.transpose(0, 2, 1)

    def step(self, words: list[bytes], at: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray, adam: "Adam") -> float:
        """One Adam step on windows ``at`` (places, windows: numbers into ``words``; padding is masked)."""
        vectors, (ids, grams, starts, counts) = self.word_vectors(words)
        loss, g, dgates = self.gradients(self.project(vectors)[at], mask, y, weight)
        h3 = 3 * self.shape.hidden
        flat = np.zeros((len(words), 2 * h3), np.float32)
        np.add.at(flat, at.ravel(), dgates.reshape(-1, 2 * h3))
        dv = 0
        for side in (0, 1):
            d = flat[:, h3 * side:h3 * (side + 1)]
            g[f"wx{side}"], g[f"b{side}"] = vectors.T @ d, d.sum(axis=0)
            dv = dv + d @ self.p[f"wx{side}"].T
        k = self.shape.word_dim
        adam.rows("words", self.p, ids, dv[:, :k])
        adam.rows("grams", self.p, grams, np.repeat(dv[:, k:] / counts, counts[:, 0], axis=0))
        adam.dense(self.p, g)
        return loss


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.01, decay: float = 0.01):
        self.rate, self.decay, self.t = rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def _move(self, m, v, g):
        m *= 0.9
        m += 0.1 * g
        v *= 0.99
        v += 0.01 * g * g
        t = self.t + 1
        return self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)

    def rows(self, name: str, params: dict[str, np.ndarray], rows: np.ndarray, g: np.ndarray) -> None:
        """Only the embedding rows that the batch used move."""
        used, place = np.unique(rows, return_inverse=True)
        total = np.zeros((len(used), g.shape[1]), np.float32)
        np.add.at(total, place, g)
        m, v = self.m[name][used], self.v[name][used]
        params[name][used] -= self._move(m, v, total) + self.rate * self.decay * params[name][used]
        self.m[name][used], self.v[name][used] = m, v

    def dense(self, params: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        for k, d in g.items():
            params[k] -= self._move(self.m[k], self.v[k], d) + self.rate * self.decay * params[k]
        self.t += 1


def window_starts(n: int, window: int = WINDOW, stride: int = 1) -> np.ndarray:
    """First words of the windows of n words. A text shorter than a window is one window; the
    last window ends with the text."""
    if n <= 0:
        return np.zeros(0, np.int64)
    last = max(0, n - window)
    starts = np.arange(0, last + 1, stride)
    return starts if starts[-1] == last else np.append(starts, last)


def window_places(n: int, window: int = WINDOW, stride: int = 1) -> np.ndarray:
    """(windows, window) word numbers of the windows of n words; -1 is padding."""
    at = window_starts(n, window, stride)[:, None] + np.arange(window)
    return np.where(at < n, at, -1)


class Scorer:
    """Evidence of whole texts; keeps the gates of words met so far in a bounded table."""

    def __init__(self, net: Network, keep_words: int = 250_000, batch: int = 1024, words: int = 1 << 15):
        self.net, self.keep, self.batch, self.words = net, keep_words, batch, words
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.gates = np.zeros((1, 6 * self.net.shape.hidden), np.float32)  # place 0: padding
        self.used = 1

    def _learn(self, new: list[bytes]) -> None:
        for at in range(0, len(new), 50_000):
            part = new[at:at + 50_000]
            rows = self.net.project(self.net.word_vectors(part)[0]).astype(np.float32)
            if self.used + len(part) > len(self.gates):
                grown = np.zeros((max(2 * len(self.gates), self.used + len(part)), self.gates.shape[1]), np.float32)
                grown[:self.used] = self.gates[:self.used]
                self.gates = grown
            self.gates[self.used:self.used + len(part)] = rows
            self.place.update(zip(part, range(self.used, self.used + len(part))))
            self.used += len(part)

    def numbers(self, many: list[list[bytes]]) -> list[np.ndarray]:
        """Table places of the words of some texts, valid until the next call."""
        place, new, found = self.place, [], []
        for words in many:
            at = list(map(place.get, words))
            if None in at:
                for i, known in enumerate(at):
                    if known is None:
                        w = words[i]
                        if w not in place:
                            place[w] = self.used + len(new)
                            new.append(w)
                        at[i] = place[w]
            found.append(np.array(at, np.int64))
        if new and self.used + len(new) > self.keep and self.used > 1:  # full: start anew with these texts
            self.clear()
            return self.numbers(many)
        self._learn(new)
        return found

    def _texts(self, texts) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(number of the first text, word numbers of some texts)."""
        held: list[list[bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            held.append(split_words(text))
            size += len(held[-1])
            if size >= self.words:
                yield i + 1 - len(held), self.numbers(held)
                held, size = [], 0
        yield len(texts) - len(held), self.numbers(held)

    def windows(self, texts, stride: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text numbers, logits) of all windows in order, in batches; with ``stride`` 1 every
        window there is. A text's windows may span batches."""
        for first, some in self._texts(texts):
            whole = [i for i, own in enumerate(some) if len(own) >= WINDOW] if stride == 1 else []
            yield from self._gathered(first, some, set(range(len(some))).difference(whole), stride)
            if whole:
                yield from self._slid(np.repeat(np.array(whole) + first, [len(some[i]) for i in whole]), np.concatenate([some[i] for i in whole]))

    def _slid(self, owner: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows of texts laid end to end; those that reach into the next text are left out."""
        for at in range(0, len(words) - WINDOW + 1, self.batch):
            part = words[at:at + self.batch + WINDOW - 1]
            logit = self.net.slide(np.ascontiguousarray(self.gates[part].T))
            begin, end = owner[at:at + len(logit)], owner[at + WINDOW - 1:at + WINDOW - 1 + len(logit)]
            inside = begin == end
            yield begin[inside], logit[inside]

    def _gathered(self, first: int, some: list[np.ndarray], chosen, stride: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows gathered one by one: short texts, which need padding, and sparse windows."""
        owner, rows, n = [], [], 0
        for i in sorted(chosen):
            at = window_places(len(some[i]), stride=stride)
            own = np.append(some[i], 0)
            for s in range(0, len(at), self.batch):
                rows.append(own[at[s:s + self.batch]])
                owner.append(np.full(len(rows[-1]), i + first))
                n += len(rows[-1])
                if n >= self.batch:
                    yield self._flush(owner, rows)
                    owner, rows, n = [], [], 0
        if rows:
            yield self._flush(owner, rows)

    def _flush(self, owner: list[np.ndarray], rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at = np.ascontiguousarray(np.concatenate(rows).T)
        return np.concatenate(owner), self.net.run(self.gates[at], (at > 0).astype(np.float32))

    def evidence(self, texts: list) -> np.ndarray:
        """(texts, 3): largest window logit, sum of the windows' probabilities, windows."""
        out = np.zeros((len(texts), 3))
        out[:, 0] = _FLOOR
        for owner, logit in self.windows(texts):
            if not len(owner):
                continue
            at = np.flatnonzero(np.diff(owner, prepend=-1))  # a text's windows follow each other
            i = owner[at]
            out[i, 0] = np.maximum(out[i, 0], np.maximum.reduceat(logit, at))
            out[i, 1] += np.add.reduceat(1 / (1 + np.exp(-np.clip(logit, -30, 30))), at, dtype=np.float64)
            out[i, 2] += np.diff(at, append=len(owner))
        return out


@dataclass(frozen=True)
class Model:
    params: dict[str, np.ndarray]
    curve: np.ndarray  # weights of (1, largest logit, log of summed probabilities, log windows)
    shape: Shape = Shape()

    def scorer(self) -> Scorer:
        return Scorer(Network(self.shape, params=self.params))

    def scores(self, texts: list, scorer: Scorer) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(scorer.evidence(texts)) @ self.curve, -40, 40)))


def _design(found: np.ndarray) -> np.ndarray:
    best, total, count = found.T
    return np.stack([np.ones(len(best)), np.clip(best, _FLOOR, -_FLOOR), np.log(total + 0.05), np.log(np.maximum(count, 1.0))], axis=1)


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic fit by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge * np.eye(len(w)) * 0.1
        step = np.linalg.solve(h, x.T @ (p - y) + 0.1 * ridge * w)
        w -= step
        if abs(step).max() < 1e-8:
            break
    return w


def train(texts: list, y: np.ndarray, rounds: int = 8, per_text: int = 12, least_steps: int = 20, drop: float = 0.05, shape: Shape = Shape(), seed: int = 5) -> Model:
    """Train on whole texts with labels (1 toxic): the texts' windows are scored each
    round; at most ``per_text`` windows of a text enter one round's steps. A round makes
    at least ``least_steps`` steps, so few texts are passed over several times.
    Words of a window are left out with chance ``drop``, so no single mild word decides."""
    rng = np.random.default_rng(seed)
    net = Network(shape, seed)
    if not (y > 0).any() or (y > 0).all():
        share = ((y > 0).sum() + 1) / (len(y) + 2)
        return Model(net.p, np.array([math.log(share / (1 - share)), 0.0, 0.0, 0.0]), shape)
    held = np.arange(len(texts)) % 5 == 0
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    words = [split_words(t) for t in texts]
    windows = [window_places(len(w), stride=TRAIN_STRIDE) for w in words]
    adam = Adam(net.p)
    logits: list[np.ndarray] | None = None
    for turn in range(rounds):
        adam.rate = 0.01 if turn < rounds - 2 else 0.003
        if turn >= 2:
            logits = [np.full(len(w), _FLOOR) for w in windows]
            done = np.zeros(len(texts), np.int64)
            for owner, part in Scorer(net).windows(texts, TRAIN_STRIDE):
                for i in np.unique(owner):
                    own = part[owner == i]
                    logits[i][done[i]:done[i] + len(own)] = own
                    done[i] += len(own)
        chosen = []  # (text, window, label)
        for i in np.flatnonzero(~held):
            n = len(windows[i])
            if not n:
                continue
            if logits is None:
                pick = rng.permutation(n)[:per_text]
            elif y[i] > 0:
                order = np.argsort(-logits[i])[:per_text]
                pick = order[(np.arange(len(order)) == 0) | (logits[i][order] > 0)]
            else:
                pick = np.unique(np.concatenate([np.argsort(-logits[i])[:per_text // 3], rng.permutation(n)[:per_text // 3]]))
            chosen += [(i, k, y[i]) for k in pick]
        marks = np.array([c[2] for c in chosen])
        balance = np.where(marks > 0, (marks <= 0).sum() / max(1, (marks > 0).sum()), 1.0)
        balance = np.minimum(balance, 4.0)
        passes = max(1, -(-least_steps * 256 // max(1, len(chosen))))
        order = np.concatenate([rng.permutation(len(chosen)) for _ in range(passes)])
        for s in range(0, len(order), 256):
            batch = [chosen[k] for k in order[s:s + 256]]
            vocabulary: dict[bytes, int] = {}
            at = np.zeros((WINDOW, len(batch)), np.int64)
            mask = np.zeros((WINDOW, len(batch)), np.float32)
            for row, (i, k, _) in enumerate(batch):
                for col, place in enumerate(windows[i][k]):
                    if place >= 0:
                        at[col, row] = vocabulary.setdefault(words[i][place], len(vocabulary))
                        mask[col, row] = 1
            mask *= (rng.random(mask.shape) >= drop) | (mask.sum(axis=0) < 2)
            weight = balance[order[s:s + 256]] / len(batch)
            net.step(list(vocabulary), at, mask, marks[order[s:s + 256]].astype(np.float32), weight.astype(np.float32), adam)
    seen = np.flatnonzero(held) if held.any() else np.arange(len(texts))
    found = Scorer(net).evidence([texts[i] for i in seen])
    return Model(net.p, _curve(_design(found), (y[seen] > 0).astype(float)), shape)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = 1500) -> Model:
    """Train on labelled rows of ``docs`` (doc_id, text) outside the held-out fifth: at most
    about ``most`` rows of each label, drawn by hash. That bound is what the driver holds."""
    rows, n = sample(docs, labels, label, most)
    drawn = rows.select("label", "text", F.xxhash64("doc_id", "text").alias("key")).toPandas().sort_values(["key", "label"])
    y = drawn["label"].to_numpy().astype(np.float64) if len(drawn) else np.zeros(0)
    model = train(drawn["text"].tolist(), y)
    # The draw changes the classes' shares: shift the curve back to those of all labelled rows.
    good, bad = n.get(1, 0), n.get(0, 0)
    if good and bad and (y > 0).any() and (y <= 0).any():
        shift = math.log(good / bad) - math.log((y > 0).sum() / (y <= 0).sum())
        return Model(model.params, model.curve + np.array([shift, 0.0, 0.0, 0.0]), model.shape)
    return model


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, most: int = 1500) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    Null and empty texts have no window and get the score of the least evidence; texts are
    scored whole; repeated rows get equal scores; extra columns are not carried; an empty
    table gives no rows. The model travels as one broadcast of fixed size (its parameters).
    """
    model = fit(docs, labels, most=most)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = shared.value.scorer()
        for texts in batches:
            yield pd.Series(shared.value.scores(texts.tolist(), scorer), dtype="float64")

    return (docs.select("doc_id", held_out().alias("held_out"), score_of(F.col("text")).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))
