import random

import numpy as np
import pytest

from adlens.llm import toxicity as tx


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def squash(x):
    return x / (1 + abs(x))


def plain_logit(net, words):
    """The network written out word by word for one window."""
    p, h = net.p, net.shape.hidden
    vectors = [net.word_vectors([w])[0][0] for w in words]
    states = np.zeros((len(words), 2 * h))
    for side, order in ((0, range(len(words))), (1, reversed(range(len(words))))):
        s = np.zeros(h)
        for k in order:
            x, g = vectors[k] @ p[f"wx{side}"] + p[f"b{side}"], s @ p[f"wh{side}"]
            z, r = (1 + squash(x[:h] + g[:h])) / 2, (1 + squash(x[h:2 * h] + g[h:2 * h])) / 2
            c = squash(x[2 * h:] + r * g[2 * h:])
            s = z * s + (1 - z) * c
            states[k, h * side:h * side + h] = s
    e = np.exp(squash(states @ p["att"]) @ p["att_v"])
    return (e / e.sum()) @ states @ p["out"] + p["bias"][0]


def every_window(words):
    """Every run of 12 neighbouring words; a shorter text is one window."""
    return [words[s:s + 12] for s in range(max(1, len(words) - 11))] if words else []


def test_all_windows_are_scored_as_written_out():
    net = tx.Network(seed=9)
    rng = random.Random(0)
    texts = [None, "", "one", "É, über! (word)"] + [" ".join(rng.choice(["ab", "cd.", "Éf", "ghij", "k"]) + str(rng.randrange(50)) for _ in range(n)) for n in (8, 11, 12, 13, 24, 55, 56, 57, 300)]
    for batch, hold in ((4, 1), (7, 60), (1024, 1 << 15)):
        for text, (b, total, c) in zip(texts, tx.Scorer(net, keep_words=120, batch=batch, words=hold).evidence(texts)):
            logits = [plain_logit(net, w) for w in every_window(tx.split_words(text))]
            assert c == len(logits)
            assert b == pytest.approx(max(logits, default=tx._FLOOR), abs=1e-4)
            assert total == pytest.approx(sum(sigmoid(x) for x in logits), abs=1e-4)


def test_a_passage_counts_alike_at_every_place():
    """A 20-word passage, moved over a clean text word by word: all its windows are always
    there, so the largest logit is one and the same, and the score stays above the clean text's."""
    rng = random.Random(2)
    model = tx.train(*corpus(450, rng))
    clean = [f"w{rng.randrange(300)}" for _ in range(120)]
    cue = [f"w{k}" for k in range(8)] + ["grubble", "snarkle", "w9", "foulmux"] + [f"w{k}" for k in range(20, 28)]
    texts = [" ".join(clean[:at] + cue + clean[at:]) for at in range(len(clean) + 1)]
    found, scorer = model.scorer().evidence(texts), model.scorer()
    assert (found[:, 2] == 120 + 20 - 11).all()
    own = model.scorer().evidence([" ".join(cue)])[0]
    assert (found[:, 0] >= own[0] - 1e-4).all()
    assert model.scores(texts, scorer).min() > model.scores([" ".join(clean)], scorer)[0]
    assert (model.scores(texts, scorer) >= 0.5).all()


def test_gradients():
    net = tx.Network(tx.Shape(64, 64, 3, 3, 4))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    gates, mask = rng.standard_normal((5, 3, 24)), np.ones((5, 3))
    mask[3:, 1] = 0
    y, weight = np.array([1.0, 0, 1]), np.array([1.0, 2.0, 0.5])
    _, grads, dgates = net.gradients(gates, mask, y, weight)
    for name, array, grad in [*((k, net.p[k], grads[k]) for k in ("wh0", "wh1", "att", "att_v", "out", "bias")), ("gates", gates, dgates)]:
        for _ in range(6):
            i = tuple(rng.integers(0, s) for s in array.shape)
            old, e = array[i], 1e-4
            array[i] = old + e
            up = net.gradients(gates, mask, y, weight)[0]
            array[i] = old - e
            down = net.gradients(gates, mask, y, weight)[0]
            array[i] = old
            assert grad[i] == pytest.approx((up - down) / (2 * e), rel=1e-4, abs=1e-6), name


def test_word_codes_hold_each_words_own_trigrams():
    words = [b"a", b"word", b"..", "é".encode(), b"x" * 50]
    shape = tx.Shape()
    _, grams, starts = tx.word_codes(words, shape)
    for k, w in enumerate(words):
        _, own, _ = tx.word_codes([w], shape)
        end = starts[k + 1] if k + 1 < len(words) else len(grams)
        assert (grams[starts[k]:end] == own).all()


def corpus(n, rng):
    mild, nasty = [f"w{i}" for i in range(300)], ["grubble", "snarkle", "foulmux"]
    texts, y = [], []
    for i in range(n):
        words = [rng.choice(mild) for _ in range(rng.randrange(5, 150))]
        if i % 3 == 0:
            for _ in range(1 + len(words) // 40):
                words[rng.randrange(len(words))] = rng.choice(nasty) + rng.choice(["", ".", "ed", "s!"])
        texts.append(" ".join(words))
        y.append(float(i % 3 == 0))
    return texts, np.array(y)


def test_learns_words_and_their_forms():
    rng = random.Random(2)
    model = tx.train(*corpus(450, rng))
    texts, y = corpus(300, rng)
    s = model.scores(texts, model.scorer())
    assert ((s >= 0.5) == (y > 0)).mean() >= 0.95
    long = " ".join(f"w{i % 300}" for i in range(4000))
    clean, hit = model.scores([long, long + " snarkling grubbles foulmux"], model.scorer())
    assert hit > clean


def test_odd_rows(odd_docs, no_docs, labels):
    rows = tx.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (0, 1, 2)}) == 1  # no words
    assert tx.classify(no_docs, labels).count() == 0
    assert all(r["score"] == 0.5 for r in tx.classify(odd_docs, labels.limit(0)).collect())
