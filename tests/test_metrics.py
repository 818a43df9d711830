from pyspark.sql import functions as F
from pytest import approx

from replylane.operators import judging, metrics

PAIRS = [("a", "a"), ("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("a", "d")]


def frame(spark, rows=PAIRS):
    return spark.createDataFrame(rows, "truth string, pred string")


def test_per_label_and_report(spark):
    report = {r["label"]: r for r in metrics.class_report(frame(spark), "truth", "pred").collect()}
    assert set(report) == {"a", "b", "c", "d", "accuracy", "macro avg", "weighted avg"}
    assert report["a"]["precision"] == approx(2 / 3) and report["a"]["recall"] == approx(2 / 4)
    assert report["b"]["f1"] == approx(2 / 3)
    # Only in the truth, and only predicted: zero, not null.
    assert (report["c"]["precision"], report["c"]["recall"], report["c"]["support"]) == (0, 0, 1)
    assert (report["d"]["precision"], report["d"]["recall"], report["d"]["support"]) == (0, 0, 0)
    assert report["accuracy"]["f1"] == approx(3 / 6)
    assert report["macro avg"]["f1"] == approx((4 / 7 + 2 / 3) / 4)
    assert report["weighted avg"]["recall"] == approx(3 / 6)
    assert report["weighted avg"]["support"] == 6


def test_systems_side_by_side(spark):
    df = frame(spark)
    systems = {"majority": metrics.majority_label(df, "truth"), "own": F.col("pred")}
    stacked = metrics.stack_systems(df, "truth", systems)
    got = {r["system"]: r for r in metrics.intent_scores(stacked, "truth", "pred", "system").collect()}
    assert got["own"]["accuracy"] == approx(0.5)
    assert got["majority"]["accuracy"] == approx(4 / 6)
    assert got["majority"]["macro_f1"] == approx((8 / 10) / 3)


def test_majority_tie_goes_to_the_lower_label(spark):
    df = frame(spark, [("z", "a"), ("b", "a"), ("z", "a"), ("b", "a")])
    assert df.select(metrics.majority_label(df, "truth").alias("m")).first()["m"] == "b"


def test_binary_scores(spark):
    rows = [("x", 1, 1), ("x", 1, 0), ("x", 0, 1), ("x", 0, 0), ("none", 1, 0), ("none", 0, 0)]
    df = spark.createDataFrame(rows, "system string, truth int, pred int")
    got = {r["system"]: tuple(r)[1:] for r in metrics.binary_scores(df, "truth", "pred", "system").collect()}
    assert got == {"x": (0.5, 0.5, 0.5), "none": (0.0, 0.0, 0.0)}


def test_published_escalation_figures(spark):
    """66 hits, 54 misses, 16 false alarms and 59 true negatives: 0.805, 0.550, 0.653."""
    rows = [(1, 1)] * 66 + [(1, 0)] * 54 + [(0, 1)] * 16 + [(0, 0)] * 59
    df = spark.createDataFrame(rows, "truth int, pred int").withColumn("system", F.lit("rules"))
    scores = metrics.binary_scores(df, "truth", "pred", "system").first()
    assert [round(scores[m], 3) for m in ("precision", "recall", "f1")] == [0.805, 0.55, 0.653]


def test_confusion_matrix_keeps_empty_labels(spark):
    table = metrics.confusion_matrix(frame(spark), "truth", "pred", ["a", "b", "c", "d"])
    rows = {r["truth"]: [r[x] for x in "abcd"] for r in table.collect()}
    assert rows == {"a": [2, 1, 0, 1], "b": [0, 1, 0, 0], "c": [1, 0, 0, 0], "d": [0, 0, 0, 0]}


def test_distribution_lists_all_labels(spark):
    got = metrics.label_distribution(frame(spark), "truth", ["c", "x", "a", "b"]).collect()
    assert [(r["truth"], r["n"]) for r in got] == [("c", 1), ("x", 0), ("a", 4), ("b", 1)]
    assert sum(r["share"] for r in got) == approx(1.0)


def test_flags_and_rates(spark):
    df = spark.createDataFrame(
        [("a", "a", "auto", "auto", "s"), ("a", None, "auto", "escalate", "s"), ("b", "b", None, "auto", "t")],
        "gold_intent string, pred_intent string, gold_escalate string, pred_escalate string, g string",
    )
    flags = metrics.correctness_flags(df).collect()
    assert [(r["intent_correct"], r["escalate_correct"]) for r in flags] == [
        (True, True), (False, False), (True, False)]
    strata = metrics.stratum_accuracy(df, "gold_intent", "pred_intent", "g").collect()
    assert {r["g"]: r["accuracy"] for r in strata} == {"s": 0.5, "t": 1.0}
    rate = metrics.agreement_rate(df, "gold_intent", "pred_intent").first()["agreement"]
    assert rate == approx(2 / 3)


def test_kappa(spark):
    rows = [("d", a, b) for a, b, n in ((1, 1, 20), (1, 2, 5), (2, 1, 10), (2, 2, 15)) for _ in range(n)]
    rows += [("same", 3, 3)] * 4 + [("d", None, 1)]
    df = spark.createDataFrame(rows, "dimension string, a int, b int")
    got = {r["dimension"]: r for r in metrics.kappa(df, "dimension", "a", "b").collect()}
    assert got["d"]["agreement"] == approx(0.7) and got["d"]["kappa"] == approx(0.4)
    assert got["d"]["n"] == 50 and got["same"]["kappa"] is None


def test_judging(spark):
    drafts = spark.createDataFrame(
        [(i, "q", "r") for i in "abcde"], "pair_id string, customer_clean string, draft_reply string"
    )
    answers = [
        ("a", '{"grounded": 5, "relevant": 4, "tone": 3, "actionable": 2, "notes": "fine"}'),
        ("b", '```json\n{"grounded": 1, "relevant": 1, "tone": 1, "actionable": 1, "notes": ""}\n```'),
        ("c", "sorry"), ("d", '{"grounded": 9, "relevant": 4, "tone": 3}'), ("e", '[1]'),
    ]
    scores = judging.judged_replies(drafts, spark.createDataFrame(answers, "pair_id string, response string"))
    got = {r["pair_id"]: r for r in scores.collect()}
    assert [got[i]["grounded"] for i in "abcde"] == [5, 1, None, 9, None]
    assert [got[i]["in_range"] for i in "abcde"] == [True, True, False, False, False]
    assert got["c"]["notes"].startswith("error: ") and got["a"]["notes"] == "fine"
    assert got["d"]["actionable"] is None and got["d"]["tone"] == 3
    means = {r["dimension"]: r["mean_score"] for r in judging.judge_means(scores).collect()}
    assert means["grounded"] == 5.0 and means["actionable"] == 1.5
    human = spark.createDataFrame(
        [("a", 4, 4, 4, 4), ("c", 1, 1, 1, 1)],
        "pair_id string, human_grounded int, human_relevant int, human_tone int, human_actionable int",
    )
    gaps = judging.mean_difference(judging.with_human(scores, human)).collect()
    assert {r["dimension"]: (r["n"], r["mean_abs_diff"]) for r in gaps} == {
        "grounded": (2, 1.0), "relevant": (2, 0.0), "tone": (2, 1.0), "actionable": (2, 2.0)}


def test_labels_off_the_list_count_as_others(spark):
    rows = [("a", "a"), ("a", "x"), ("y", "b"), (None, "b"), ("b", None)]
    df = spark.createDataFrame(rows, "t string, p string")
    got = {r["truth"]: (r["a"], r["b"], r["rest"]) for r in metrics.confusion_matrix(df, "t", "p", ["a", "b"], "rest").collect()}
    assert got == {"a": (1, 0, 1), "b": (0, 0, 1), "rest": (0, 2, 0)}
