"""Quality classifier: Naive Bayes support vectors (operator 6).

A text becomes binary n-gram indicators. Every indicator is scaled by its class
log-count ratio

    r = log((alpha + p) / (alpha * features + sum p)) - log((alpha + q) / (alpha * features + sum q))

with p and q the numbers of good and bad training texts that show it, counted over all
labelled training texts in Spark. On the scaled indicators a linear hinge-loss model is
fitted by dual coordinate descent. A logistic curve on the margins of texts the fit did
not see turns margins into probabilities.

Indicators: byte trigrams of the lower-cased text, 6-grams of its letter shapes (upper,
lower, digit, gap, other; a run of one shape is kept up to two long), and coarse steps of
three shares (other marks, the most frequent word, different words; the last two by the
text's number of words), all hashed into ``2 ** bits`` places. Whole texts count.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SHAPE = np.full(256, 3, np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:], _SHAPE[48:58] = 0, 1, 1, 2
for _gap in (9, 10, 11, 12, 13, 32):
    _SHAPE[_gap] = 4


def _spread(codes: np.ndarray, salt: int, bits: int) -> np.ndarray:
    """Multiplicative hash of 32-bit numbers to ``bits`` bits; overwrites ``codes``."""
    codes += np.uint32(salt << 24)
    codes *= np.uint32(0x9E3779B1)
    codes >>= np.uint32(32 - bits)
    return codes


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Sorted places of the indicators a text shows; none for a null or empty text."""
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return np.zeros(0, np.int32)
    raw = np.frombuffer(b" " + data + b" ", np.uint8)
    x = _LOWER[raw].astype(np.uint32)
    code = x[:-2] << np.uint32(8)
    code |= x[1:-1]
    code <<= np.uint32(8)
    code |= x[2:]
    found = [_spread(code, 0, bits)]
    shape = _SHAPE[raw]
    same = shape[1:] == shape[:-1]
    keep = np.ones(len(shape), bool)
    keep[2:] = ~(same[1:] & same[:-1])
    shape = shape[keep]
    if len(shape) > 5:
        wide = shape.astype(np.uint32)
        code = wide[:-5].copy()
        for k in range(1, 6):
            code *= np.uint32(5)
            code += wide[k:len(wide) - 5 + k]
        found.append(_spread(code, 1, bits))
    words = data.split()
    n = len(words)
    if n:
        times = Counter(words)
        size = n.bit_length()
        marks = int(16 * np.count_nonzero(shape == 3) / max(1, np.count_nonzero(shape != 4)))
        profile = [marks, 100 + size * 9 + 8 * max(times.values()) // n, 500 + size * 9 + 8 * len(times) // n]
        found.append(_spread(np.array(profile, np.uint32), 2, bits))
    places = np.concatenate(found).view(np.int32)
    places.sort()
    return places[np.concatenate(([True], places[1:] != places[:-1]))]


@dataclass(frozen=True)
class Model:
    """weights: one per indicator place (the ratio times the fitted weight); a, b: logistic curve."""
    weights: np.ndarray
    bias: float
    a: float
    b: float
    bits: int = BITS

    def margin(self, places: np.ndarray) -> float:
        if not len(places):
            return self.bias
        return float(self.weights[places].sum() / math.sqrt(len(places))) + self.bias

    def score(self, text: str | None) -> float:
        return 1.0 / (1.0 + math.exp(-min(60.0, max(-60.0, self.a * self.margin(features(text, self.bits)) + self.b))))


def counts(train: DataFrame, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(p, q, good texts, bad texts): texts that show each indicator, by class, over all of
    ``train`` (text, label). Tasks add up dense vectors; their sum is one row per indicator."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((2, (1 << bits) + 1), np.int64)  # the last place counts texts
        for b in batches:
            for text, label in zip(b["text"], b["label"]):
                n[int(label), features(text, bits)] += 1
                n[int(label), -1] += 1
        place = np.flatnonzero(n.any(axis=0))
        yield pd.DataFrame({"place": place.astype(np.int32), "q": n[0, place], "p": n[1, place]})

    sums = (train.select("text", "label").mapInPandas(run, "place int, q long, p long")
            .groupBy("place").agg(F.sum("q").alias("q"), F.sum("p").alias("p"))).toPandas()  # at most 2**bits rows
    n = np.zeros((2, (1 << bits) + 1), np.float64)
    n[0, sums["place"]], n[1, sums["place"]] = sums["q"], sums["p"]
    return n[1, :-1], n[0, :-1], int(n[1, -1]), int(n[0, -1])


def ratios(p: np.ndarray, q: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    p, q = p + alpha, q + alpha
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: np.ndarray,
                            epochs: int = 12, seed: int = 1, tol: float = 0.01) -> tuple[np.ndarray, float]:
    """min |w|^2 / 2 + sum cost_i * max(0, 1 - y_i w.x_i) over rows of places, x = scale / sqrt(places).

    One dual variable per row, 0 to cost_i, is set to its best value at a time; the bias is
    the weight of a constant feature 1. Stops when no projected gradient exceeds ``tol``.
    """
    w, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    xs = [scale[r] / math.sqrt(max(1, len(r))) for r in rows]
    q = np.array([float(x @ x) + 1.0 for x in xs])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            r, x = rows[i], xs[i]
            g = y[i] * (float(w[r] @ x) + bias) - 1.0
            pg = min(g, 0.0) if alpha[i] == 0 else (max(g, 0.0) if alpha[i] == cost[i] else g)
            worst = max(worst, abs(pg))
            if pg:
                new = min(max(alpha[i] - g / q[i], 0.0), cost[i])
                step = (new - alpha[i]) * y[i]
                w[r] += step * x
                bias += step
                alpha[i] = new
        if worst < tol:
            break
    return w, bias


def logistic(margins: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a m + b))) by Newton steps, with smoothed targets."""
    good, bad = int((y > 0).sum()), int((y <= 0).sum())
    t = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, math.log((good + 1) / (bad + 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        d, v = p - t, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * margins * margins).sum() + 1e-6, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, np.array([(d * margins).sum(), d.sum()]))
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-6)), float(b)


def _marks(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of labels 0 and 1 outside the held-out fifth."""
    return labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("label in (0, 1)").filter(~held_out())


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label) of labelled rows outside the held-out fifth; labels other than 0
    and 1 are ignored. Labels grow with the documents, so the join is a shuffled one at
    every size."""
    return docs.select("doc_id", "text").filter(~held_out()).join(_marks(labels, label).hint("merge"), "doc_id")


def held_out():
    """crc32 of the doc_id as text divides by 5 (a null doc_id is not held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> tuple[DataFrame, dict[int, int]]:
    """(training rows of at most about ``most`` labels of each class, labels per class).

    Labels are drawn by a hash of the doc_id before they meet the texts: their number is
    bounded by ``most``, so they are broadcast and no text is shuffled.
    """
    marks = _marks(labels, label)
    n = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for k, v in n.items():
        share = F.when(F.col("label") == k, F.lit(min(1.0, most / v))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    return docs.select("doc_id", "text").join(F.broadcast(marks.filter(draw < share)), "doc_id"), n


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 4000, cost: float = 1.0,
        bits: int = BITS) -> Model:
    """Fit on labelled rows of ``docs`` (doc_id, text) outside the held-out fifth.

    The log-count ratios count every training row. The hinge-loss model and the logistic
    curve see at most about ``most`` rows per class, drawn by hash: the bound of what the
    driver holds. Without rows of both classes the score is the share of good ones
    (a half without any).
    """
    p, q, good, bad = counts(training_rows(docs, labels, label), bits)
    if not good or not bad:
        share = (good + 1) / (good + bad + 2)
        return Model(np.zeros(1 << bits), 0.0, 1.0, math.log(share / (1 - share)), bits)
    r = ratios(p, q)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"label": b["label"], "key": b["key"], "places": [features(t, bits).tobytes() for t in b["text"]]})

    drawn = (sample(docs, labels, label, most)[0].select("label", F.xxhash64("doc_id", "text").alias("key"), "text")
             .mapInPandas(places, "label int, key long, places binary").toPandas().sort_values(["key", "label"]))
    rows = [np.frombuffer(x, np.int32) for x in drawn["places"]]
    y = np.where(drawn["label"].to_numpy() == 1, 1.0, -1.0)
    fold = np.arange(len(rows)) % 4 == 0  # a quarter fits the logistic curve
    if len(set(y[~fold])) < 2 or len(set(y[fold])) < 2:
        fold[:] = False
    c = np.where(y > 0, cost, cost * max(1.0, (y > 0).sum() / max(1, (y < 0).sum())))
    use = np.flatnonzero(~fold)
    w, bias = dual_coordinate_descent([rows[i] for i in use], y[use], r, c[use])
    raw = Model(w * r, bias, 1.0, 0.0, bits)
    seen = np.flatnonzero(fold) if fold.any() else use
    margins, marks = np.array([raw.margin(rows[i]) for i in seen]), y[seen]
    # The draw may change the classes' shares: weigh the curve back to the training rows' shares.
    a, b = logistic(margins, marks)
    drawn_odds = (marks > 0).sum() / max(1, (marks < 0).sum())
    return Model(w * r, bias, a, b + math.log((good / bad) / max(drawn_odds, 1e-9)), bits)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    Null and empty texts get the score of a text without indicators; texts are read whole;
    repeated rows get equal scores; extra columns are not carried; an empty table gives no rows.
    """
    score_of = scorer(model)
    return (docs.select("doc_id", held_out().alias("held_out"), score_of(F.col("text")).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def scorer(model: Model):
    """The model as a column function. It travels to the tasks as one broadcast of fixed size
    (2**bits weights)."""
    from pyspark.sql import SparkSession
    shared = SparkSession.getActiveSession().sparkContext.broadcast(
        (model.weights.astype(np.float32), model.bias, model.a, model.b, model.bits))

    @F.pandas_udf("double")
    def score_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Model(*shared.value)
        for texts in batches:
            yield pd.Series([m.score(t) for t in texts], dtype="float64")

    return score_of


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most: int = 4000) -> DataFrame:
    """Fit on the labelled rows of ``docs`` and score all rows."""
    return score(docs, fit(docs, labels, most=most), threshold)


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most: int = 4000) -> DataFrame:
    """Rows of ``docs`` predicted good, columns unchanged."""
    score_of = scorer(fit(docs, labels, most=most))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), score_of(F.col("text")).alias("score"))
    return rows.filter(F.col("score") >= threshold).select("row.*")

