import random

import numpy as np
import pyarrow as pa

from replylane.llm import toxicity
from replylane.llm.linear import sigmoid
from replylane.llm.words import chunks


def texts(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    out, y = [], []
    for _ in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.5
        if bad:
            for _ in range(1 + len(words) // 30):
                words[rng.randrange(len(words))] = rng.choice(["Vilex", "grumof,", "HATEK!"])
        out.append(" ".join(words))
        y.append(float(bad))
    return out, np.array(y)


def prepared(column):
    network = toxicity.Network.fresh(1)
    for name in ("word", "char"):
        network.p[name] *= 20
    v, number, cuts = toxicity.read(next(chunks(column))[2])
    gates, _ = network.project(v)
    return network, v, gates, toxicity.windows(number, cuts, len(gates) - 1)


def test_fast_and_traced_pass_agree():
    network, _, gates, (rows, _) = prepared(pa.array(texts(20, 1)[0]))
    assert np.abs(network.run(gates, rows) - network.traced(gates, rows)[0]).max() < 1e-4


def test_windows_overlap_and_cover_every_word():
    number = np.arange(100)
    rows, text = toxicity.windows(number, np.array([0, 0, 5, 24, 25, 100]), 100)
    for i, (a, b) in enumerate([(0, 0), (0, 5), (5, 24), (24, 25), (25, 100)]):
        own = rows[text == i]
        assert set(own[own < 100].tolist()) == set(range(a, b))
    own = rows[text == 4]
    assert (own[1:, 0] - own[:-1, 0] == toxicity.STRIDE).all()


def test_gradient_matches_differences():
    network, v, _, (rows, _) = prepared(pa.array(["alpha beta gamma delta", "beta beta"]))
    network.p = {k: a.astype(np.float64) for k, a in network.p.items()}
    y, weight = np.array([1.0, 0.0]), np.array([0.5, 0.5])

    def loss():
        gates, _ = network.project(v)
        p = sigmoid(network.traced(gates, rows)[0])
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    g = network.gradient(v, rows, y, weight)
    for name in ("input", "forward", "backward", "look", "see", "out", "base", "word", "char"):
        value = g[name]
        if isinstance(value, tuple):
            at, own = (int(value[0][0]), 0), value[1][0, 0]
        else:
            at = (0,) * value.ndim
            own = value[at]
        a, step = network.p[name], 1e-3
        keep = a[at]
        a[at] = keep + step
        up = loss()
        a[at] = keep - step
        down = loss()
        a[at] = keep
        assert abs((up - down) / (2 * step) - own) < 1e-3


def test_held_out_accuracy():
    (train, y), (test, truth) = texts(300, 2), texts(200, 3)
    network = toxicity.learn(pa.array(train), y, updates=150)
    assert ((network.raw(pa.array(test)) > 0) == truth).mean() > 0.9


def test_scores_in_spark(spark):
    own, y = texts(60, 4)
    rows = [(i, t, "en", "s", 0.5) for i, t in enumerate(own)] + [(900, None, None, None, 1.0), (901, "", "x", "y", 1.0), (None, "a", None, "s", 0.0), (3, own[3], "en", "s", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels, updates=30)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(round(r.score, 5))
    assert len(by[3]) == 1 and by[900] == by[901]


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    network = toxicity.train(docs, labels)
    assert [r.predicted for r in toxicity.score(docs, network).collect()] == [0]
    assert toxicity.score(docs.limit(0), network).count() == 0
