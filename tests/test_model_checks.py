"""The checks on the classifier turn red when the fit stops early; staged tables can be removed."""

import os
import random

from pyspark.sql import functions as F

from replylane import staging
from replylane.operators.tfidf import TfidfModel
from replylane.plans import training
from replylane.plans.training import fit_intent_model
from replylane.registry import certificates
from replylane.registry.batch import gradient_of
from replylane.registry.certificates import coefficients
from replylane.staging import clear, stage


def test_gradient_tells_an_early_stop(spark):
    rng = random.Random(3)
    words = {"a": ["red", "blue", "sky", "sea"], "b": ["bread", "milk", "sky", "salt"], "c": ["rail", "road", "sea", "salt"]}
    rows = [(f"r{i}", " ".join(rng.choice(words[k]) for _ in range(6)), k) for i in range(90) for k in [rng.choice("aabc")]]
    df = spark.createDataFrame(rows, "pair_id string, customer_clean string, weak_intent string")
    gaps = {}
    for steps in (1000, 2):
        model = fit_intent_model(df, "customer_clean", "weak_intent", max_iter=steps)
        gaps[steps] = [r.gap for r in gradient_of(model, df).collect()]
    assert len(gaps[1000]) == 3 and max(gaps[1000]) == 0 < max(gaps[2])


def test_gradient_counts_every_row_and_makes_vectors_once(spark, monkeypatch):
    """Rows that share an id, or have none, count as they did in the fit; entries meet no others."""
    rng = random.Random(8)
    words = {"a": ["red", "blue", "sky", "sea"], "b": ["bread", "milk", "sky", "salt"], "c": ["rail", "road", "sea", "salt"]}
    rows = [(None if i % 5 == 0 else f"r{i % 7}", " ".join(rng.choice(words[k]) for _ in range(6)), k)
            for i in range(90) for k in [rng.choice("aabc")]] + [("x", "", "a"), ("y", "zzz", "b")]
    df = spark.createDataFrame(rows, "pair_id string, customer_clean string, weak_intent string")
    model = fit_intent_model(df, "customer_clean", "weak_intent")
    made, with_vector = [], TfidfModel.with_vector
    monkeypatch.setattr(TfidfModel, "with_vector", lambda *a: made.append(1) or with_vector(*a))
    gaps = {r.label: r.gap for r in gradient_of(model, df).collect()}
    assert gaps == {"a": 0, "b": 0, "c": 0} and len(made) == 1


def test_round_trip_compares_every_row_with_itself(spark, monkeypatch):
    """Rows that share an id, or have none, are compared once each; a changed model is told."""
    rows = [(None if i == 3 else f"r{i % 4}", t, k) for i, (t, k) in enumerate([("red sky sea", "a"), ("bread milk", "b")] * 6)]
    df = spark.createDataFrame(rows, "pair_id string, customer_clean string, weak_intent string")
    model = fit_intent_model(df, "customer_clean", "weak_intent")
    monkeypatch.setattr(certificates.inputs, "language_model", lambda *_: model)
    monkeypatch.setattr(certificates.inputs, "language_rows", lambda *_: df)
    found = certificates.model_round_trip(spark, "")
    assert sorted(str(r.pair_id) for r in found.collect()) == sorted(str(i) for i, *_ in rows)
    assert not any(r.differs for r in found.collect())
    other = training.IntentModel(model.vectors, model.regression, ("b", "a"))
    monkeypatch.setattr(training.IntentModel, "load", lambda *_: other)
    assert all(r.differs for r in certificates.model_round_trip(spark, "").collect())


def test_clear_removes_staged_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path))  # others keep theirs
    table = stage(spark.range(3), "gone")
    path = table.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    clear(spark)
    assert not os.path.exists(path)


def test_long_texts_are_more_than_one_task(spark):
    rows = [(" ".join(f"w{(i * 31 + j) % 900}" for j in range(300)), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "text string, y int")
    vectors = TfidfModel.fit(df, "text").with_vector(df, "text").select("features")
    entries = sum(r.features.numNonzeros() for r in vectors.collect())
    assert training.in_blocks(vectors, entries // 4).rdd.getNumPartitions() >= 4
    assert training.in_blocks(vectors, entries).rdd.getNumPartitions() == 1
    assert training.in_blocks(vectors.limit(0)).count() == 0


def test_scores_are_checked_on_vectors_made_once(spark, monkeypatch):
    rng = random.Random(4)
    words = {"a": ["red", "blue", "sky"], "b": ["bread", "milk", "sky"], "c": ["rail", "road", "sea"]}
    rows = [(f"r{i}", " ".join(rng.choice(words[k]) for _ in range(6)), k) for i in range(60) for k in [rng.choice("abc")]]
    model = fit_intent_model(spark.createDataFrame(rows, "id string, text string, y string"), "text", "y")
    asked = [(i, t) for i, t, _ in rows] + [("none", ""), ("null", None), ("odd", "zzz"), ("r1", "sky sea")]
    made, with_vector = [], TfidfModel.with_vector
    monkeypatch.setattr(TfidfModel, "with_vector", lambda *a: made.append(1) or with_vector(*a))
    gaps = certificates.score_gaps(model, spark.createDataFrame(asked, "id string, text string"), "id", "text").collect()
    assert len(made) == 1 and sorted(r.id for r in gaps) == sorted(i for i, _ in asked)
    assert all(r.gap == 0 for r in gaps)
    monkeypatch.setattr(certificates, "coefficients", lambda s, m: stage(coefficients(s, m).withColumn(
        "weights", F.transform("weights", lambda w, i: w + i)), "wrong"))
    gaps = certificates.score_gaps(model, spark.createDataFrame(asked, "id string, text string"), "id", "text").collect()
    assert {r.id for r in gaps if r.gap > 0} >= {f"r{i}" for i in range(60)}
