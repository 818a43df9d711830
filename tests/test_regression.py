"""The fit: a vanishing gradient after few passes, whatever the scale of the terms."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from replylane.operators import regression

TERMS, LABELS = 60, 3


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    often = rng.random(TERMS) ** 4  # frequent and rare terms
    x = (rng.random((400, TERMS)) < often) * rng.random((400, TERMS))
    x[7] = 0.0
    y = (x @ rng.normal(size=(TERMS, LABELS)) + rng.gumbel(size=(400, LABELS))).argmax(axis=1)
    return x, y, 0.5 + rng.random(400)


def test_fit_vanishing_gradient_and_passes(spark, data, monkeypatch):
    x, y, weight = data
    rows = [
        (Vectors.sparse(TERMS, [(int(j), float(v[j])) for j in np.flatnonzero(v)]), int(k), float(w))
        for v, k, w in zip(x, y, weight)
    ]
    df = spark.createDataFrame(rows, ["features", "label", "weight"]).repartition(5)
    passes = []
    once = regression._pass
    monkeypatch.setattr(regression, "_pass", lambda *a: passes.append(1) or once(*a))
    monkeypatch.setattr(regression, "PIECE", 50)
    penalty, total = 1e-4, weight.sum()
    ready = regression.packed(df, "features", "label", "weight")
    model = regression.fit(ready, LABELS, TERMS, total, penalty, 300, 1e-9)
    scores = x @ model.weights.T + model.offsets
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    error = (p - np.eye(LABELS)[y]) * weight[:, None]
    assert np.abs(error.T @ x / total + penalty * model.weights).max() < 1e-4
    assert np.abs(error.sum(axis=0)).max() / total < 1e-4
    assert len(passes) < 150
    said = df.select("features", model.probabilities(F.col("features")).alias("p")).collect()
    own = {tuple(v): q for v, q in zip(x.round(12), p)}
    for r in said:
        assert np.allclose(r.p, own[tuple(r.features.toArray().round(12))], atol=1e-9)


def test_saved_model(spark, tmp_path):
    kept = regression.Regression(np.arange(6.0).reshape(2, 3), np.array([0.5, -0.5]))
    kept.save(spark, str(tmp_path / "m"))
    again = regression.Regression.load(spark, str(tmp_path / "m"))
    assert (again.weights == kept.weights).all() and (again.offsets == kept.offsets).all()
    assert (kept.coefficientMatrix.toArray() == kept.weights).all()


def test_vectors_are_dealt_by_entries_to_few_tasks(spark, monkeypatch, tmp_path):
    """A pass costs a job of few tasks, however many partitions the vectors come from."""
    monkeypatch.setattr(regression, "PIECE", 60)
    monkeypatch.setattr(regression, "ENTRIES_PER_TASK", 50)
    monkeypatch.setattr(regression, "new_path", lambda *_: str(tmp_path / "vectors"))
    rng = np.random.default_rng(6)
    sizes = [0, 50, *rng.integers(0, 30, 98).tolist()]
    rows = [(Vectors.sparse(TERMS, [(j, 1.0 + i) for j in range(n)]), i % LABELS, 1.0) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, ["features", "label", "weight"])
    blocks = regression.written(regression.packed(df.repartition(30), "features", "label", "weight"))
    most = regression.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert 1 < len(blocks.tasks) <= most
    met = []
    for own in blocks.tasks:
        met.append([])
        for path, first, last in own:
            held = pa.ipc.open_file(path)
            for i in range(first, last):
                met[-1] += [len(x) // 4 for x in held.get_batch(i)["ids"].to_pylist()]
    assert sorted(sum(met, [])) == sorted(sizes)
    assert max(map(sum, met)) <= 2 * sum(sizes) / len(met) + 60
    weights, offsets = rng.normal(size=(LABELS, TERMS)), rng.normal(size=LABELS)
    x = np.array([v.toArray() for v, *_ in rows])
    scores = x @ weights.T + offsets
    logs = scores - scores.max(1, keepdims=True)
    logs -= np.log(np.exp(logs).sum(1, keepdims=True))
    sums = regression._pass(blocks, weights, offsets, True)
    y = np.arange(100) % LABELS
    assert np.isclose(sums[0], -logs[np.arange(100), y].sum())
    slope = np.column_stack([(np.exp(logs) - np.eye(LABELS)[y]).T @ x, (np.exp(logs) - np.eye(LABELS)[y]).sum(0)])
    assert np.allclose(sums[1:1 + slope.size], slope.ravel())
    none = regression.written(regression.packed(df.limit(0), "features", "label", "weight"))
    assert not none.tasks and not regression._pass(none, weights, offsets, False).any()
