import zlib

import numpy as np
from pyspark.sql import functions as F

from adlens.llm import nbsvm
from adlens.llm.common import table


def test_dual_coordinate_descent_reaches_the_primal_minimum():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(12, 4, replace=False)).astype(np.int32) for _ in range(60)]
    y = np.array([1.0 if r[0] < 3 else -1.0 for r in rows])
    scale, cost = rng.normal(1, 0.3, 12), np.full(60, 0.7)
    w, b = nbsvm.dual_coordinate_descent(rows, y, scale, cost, epochs=500, tol=1e-6)
    x = np.zeros((60, 13))
    for i, r in enumerate(rows):
        x[i, r] = scale[r] / 2
        x[i, 12] = 1

    def loss(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - y * (x @ v))).sum()

    best = loss(np.append(w, b))
    for _ in range(3000):  # no random step from the solution, small or large, gets lower
        assert loss(np.append(w, b) + rng.normal(0, 10 ** rng.uniform(-4, 0), 13)) >= best - 1e-6


def test_counts_are_of_all_training_rows(spark):
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "###  bad", i % 2) for i in range(40)], "doc_id long, text string, label int")
    p, q, good, bad = nbsvm.counts(docs.repartition(7))
    assert (good, bad) == (20, 20)
    for text, n in (("good words here", p), ("###  bad", q)):
        assert (n[nbsvm.features(text)] == 20).all()
    assert p.sum() == 20 * len(nbsvm.features("good words here"))


def test_features():
    assert len(nbsvm.features(None)) == len(nbsvm.features("")) == 0
    for text in ("a", " ", "ab", "é" * 3, "word " * 30000, "x" * 200000):
        f = nbsvm.features(text)
        assert len(f) and (np.diff(f) > 0).all() and f[0] >= 0 and f[-1] < 1 << nbsvm.BITS


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "labels")
    rows = nbsvm.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    good, bad = [r["score"] for r in rows if r["quality"]], [r["score"] for r in rows if not r["quality"]]
    assert right >= 0.93
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) >= 0.97
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in rows)


def test_odd_rows(odd_docs, no_docs, labels):
    rows = nbsvm.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert nbsvm.keep(odd_docs, labels, threshold=0.0).columns == odd_docs.columns
    assert nbsvm.classify(no_docs, labels).count() == 0
    assert nbsvm.keep(odd_docs, labels.limit(0), threshold=0.4).count() == odd_docs.count()
    flipped = labels.withColumn("quality", F.lit(None).cast("int"))
    assert all(r["score"] == 0.5 for r in nbsvm.classify(odd_docs, flipped).collect())
