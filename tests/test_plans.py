import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from replylane.functions import drafting
from replylane.operators.retrieval import CaseIndex
from replylane.packs import airline
from replylane.plans import evaluation, replies, training, triage
from replylane.streaming import live

RULES = airline.rules("StarMiles")
DESK = triage.Desk(airline.policy(), airline.templates("StarMiles"), airline.DEFAULT_INTENT, "Star")
SEEDS = [
    "please refund my ticket", "lost my bag at the airport", "flight delayed by hours",
    "boarding pass does not print", "upgrade with miles", "thanks to the lovely crew",
    "awful and rude staff", "is there a lounge", "hello friends",
]


@pytest.fixture(scope="module")
def pairs(spark):
    rnd = random.Random(3)
    filler = ["today", "tomorrow", "please", "really", "home", "plan", "trip", "day"]
    rows = []
    for i in range(180):
        text = f"{SEEDS[i % len(SEEDS)]} {' '.join(rnd.sample(filler, 3))}"
        rows.append((f"PX-{i:06d}", text, f"we are looking into it number {i}"))
    return spark.createDataFrame(rows, "pair_id string, customer_clean string, agent_clean string")


@pytest.fixture(scope="module")
def trained(spark, pairs):
    golden = pairs.where("pair_id < 'PX-000010'")
    return training.train_on_rules(pairs, RULES, golden, max_iter=300, tolerance=1e-9)


@pytest.fixture(scope="module")
def index(pairs):
    return CaseIndex.build(pairs.withColumn("weak_intent", RULES.label(F.col("customer_clean"))))


def test_metadata_and_scores(trained, pairs):
    model, meta = trained
    row = meta.first()
    assert row["n_train"] == 153 and 0.8 <= row["held_out_weak_val_accuracy"] <= 1.0
    assert list(model.labels) == sorted(model.labels)
    scored = model.classify(pairs, "customer_clean")
    assert scored.columns == [*pairs.columns, "intent", "confidence"]
    agree = scored.where(F.col("intent") == RULES.label(F.col("customer_clean"))).count()
    assert agree >= 170
    assert scored.where("confidence <= 0 or confidence > 1").count() == 0


def test_gradient_vanishes_at_the_model(spark, pairs):
    """The penalised, class-balanced loss is at its minimum: C * sum(w * loss) + |W|^2 / 2."""
    df = pairs.withColumn("y", RULES.label(F.col("customer_clean")))
    model = training.fit_intent_model(df, "customer_clean", "y", max_iter=1000, tolerance=1e-12)
    rows = model.vectors.with_vector(df, "customer_clean").select(
        vector_to_array("features").alias("x"), "y"
    ).collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    coefficients = model.regression.coefficientMatrix.toArray()
    logits = x @ coefficients.T + model.regression.interceptVector.toArray()
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    hot = (y[:, None] == np.array(model.labels)[None, :]).astype(float)
    weights = len(y) / (len(model.labels) * hot.sum(axis=0)[hot.argmax(axis=1)])
    gradient = coefficients + 2.0 * ((p - hot) * weights[:, None]).T @ x
    assert np.abs(gradient).max() < 1e-3


def test_model_round_trip(spark, trained, pairs, tmp_path):
    model, _ = trained
    model.save(spark, str(tmp_path / "m"))
    again = training.IntentModel.load(spark, str(tmp_path / "m"))
    before, after = model.classify(pairs, "customer_clean"), again.classify(pairs, "customer_clean")
    assert before.exceptAll(after).count() == 0
    top = model.top_terms(spark, 3).collect()
    assert len(top) == 3 * len(model.labels)
    assert any(r["term"].startswith("refund") for r in top if r["label"].startswith("refund"))


def test_two_labels_are_needed(spark, pairs):
    with pytest.raises(ValueError):
        training.fit_intent_model(pairs.withColumn("y", F.lit("a")), "customer_clean", "y")


def test_triage(spark, trained, index):
    asked = spark.createDataFrame(
        [(1, "please refund my ticket, again"), (2, "thanks to the lovely crew"), (3, " \n ")],
        "id long, text string",
    )
    got = {r["id"]: r for r in triage.triage(asked, trained[0], index, DESK).collect()}
    assert set(got) == {1, 2}
    assert got[1]["escalate"] and "repeated_failure" in got[1]["reasons"]
    assert got[1]["intent"] == "refund_compensation_request" and len(got[1]["hits"]) == 3
    assert f'"{got[1]["hits"][0]["agent_clean"]}")' in got[1]["draft_reply"]
    assert got[2]["draft_reply"].startswith("Thank you so much for the kind words, there!")
    assert got[1]["reply_mode"] == "template"


def test_external_replies(spark, index):
    decided = spark.createDataFrame(
        [(i, "lost my bag", "baggage_issue") for i in range(3)], "id long, text string, intent string"
    )
    drafted = triage.draft(decided, index, DESK)
    outside = spark.createDataFrame([(0, " hi ", None), (1, None, "boom")], "id long, reply string, error string")
    got = {r["id"]: r for r in triage.with_external_replies(drafted, outside).collect()}
    assert (got[0]["draft_reply"], got[0]["reply_mode"]) == ("hi", "llm")
    assert got[1]["reply_mode"] == "template_fallback (llm_error: boom)"
    assert got[2]["reply_mode"] == "template" and got[1]["draft_reply"] == got[2]["draft_reply"]
    prompt = triage.with_prompts(drafted, DESK).first()["prompt"]
    assert prompt.count("- Customer: ") == 3 and "Star" in prompt


def test_template_edges(spark):
    long_reply = "\U0001F600" * 119 + "ab{name}"
    rows = [("info_question", long_reply), ("nope", "x"), ("info_question", None)]
    df = spark.createDataFrame(rows, "intent string, top string")
    reply = drafting.template_reply(F.col("intent"), F.col("top"), DESK.templates, "other_unclear")
    first, second, third = (r[0] for r in df.select(reply).collect())
    assert first.endswith('resolved: "' + "\U0001F600" * 119 + 'a")')
    assert second == DESK.templates["other_unclear"].replace("{name}", "there")
    assert third == "Thanks for reaching out, there. "
    braces = spark.createDataFrame([("info_question", "use {name} and {retrieved_hint}")], "intent string, top string")
    assert "use {name} and {retrieved_hint}" in braces.select(reply).first()[0]
    empty = spark.range(1).select(F.array().cast("array<struct<customer_clean:string,agent_clean:string>>").alias("h"))
    asked = empty.select(drafting.judge_prompt(F.lit("q"), F.col("h"), F.lit("r"), "Star")).first()[0]
    assert "(none retrieved)" in asked


def test_evaluation(spark):
    rows = [
        ("p1", "refund please", "refund_compensation_request", "escalate", "refund_compensation_request", 0.9),
        ("p2", "thanks", "praise_thanks", "auto", "praise_thanks", 0.9),
        ("p3", "hello", "other_unclear", "auto", "praise_thanks", 0.1),
        ("p4", "thanks for nothing", "service_complaint", "escalate", "praise_thanks", 0.8),
    ]
    df = spark.createDataFrame(
        rows, "pair_id string, customer_clean string, gold_intent string, gold_escalate string, intent string, confidence double"
    )
    result = evaluation.evaluate(df, RULES.label(F.col("customer_clean")), DESK.policy)
    intents = {r["system"]: r["accuracy"] for r in result.intents.collect()}
    assert intents == {"trivial_majority_class": 0.25, "simple_rule_baseline": 0.75, "trained_classifier": 0.5}
    escalations = {r["system"]: tuple(r)[1:] for r in result.escalations.collect()}
    assert escalations["trivial_always_escalate"] == (0.5, 1.0, pytest.approx(2 / 3))
    assert escalations["trivial_never_escalate"] == (0.0, 0.0, 0.0)
    assert escalations["rule_engine"] == (0.5, 0.5, 0.5)
    assert [tuple(r) for r in result.matrix.orderBy("truth").collect()] == [("auto", 1, 1), ("escalate", 1, 1)]
    predicted = {r["pair_id"]: r for r in result.predictions.collect()}
    assert predicted["p3"]["pred_escalate"] == "escalate" and not predicted["p3"]["intent_correct"]
    assert predicted["p1"]["escalate_correct"]


def test_stream_equals_batch(spark, trained, index, tmp_path):
    texts = [(i, SEEDS[i % len(SEEDS)], i) for i in range(30)]
    frame = spark.createDataFrame(texts, "id long, text string, n long").select(
        "id", "text", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n")).alias("sent_at")
    )
    for part in ("a", "b"):
        frame.write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    decided = live.classified_stream(stream, trained[0], DESK)
    query = live.start_triage(
        decided, index, DESK, str(tmp_path / "out"), str(tmp_path / "progress"), available_now=True
    )
    query.awaitTermination()
    keep = ["id", "intent", "escalate", "draft_reply"]
    streamed = spark.read.parquet(str(tmp_path / "out")).select(*keep)
    batch = triage.triage(frame.select("id", "text"), trained[0], index, DESK).select(*keep)
    assert streamed.count() == 30
    assert streamed.exceptAll(batch).count() == 0


def test_judging_round(spark, trained, index, pairs):
    asked = replies.judge_requests(pairs, 4, trained[0], index, DESK)
    assert [r["pair_id"] for r in asked.orderBy("pair_id").collect()] == [f"PX-{i:06d}" for i in range(4)]
    assert asked.where(F.contains("prompt", "draft_reply")).count() == 4
    answers = asked.select(
        "pair_id", F.lit('{"grounded": 4, "relevant": 4, "tone": 5, "actionable": 3, "notes": "ok"}').alias("response")
    )
    human = spark.createDataFrame(
        [("PX-000001", 4, 3, 5, 1)],
        "pair_id string, human_grounded int, human_relevant int, human_tone int, human_actionable int",
    )
    result = replies.judge(asked, answers, human)
    assert {r["dimension"]: r["mean_score"] for r in result.means.collect()}["tone"] == 5.0
    gaps = {r["dimension"]: r["mean_abs_diff"] for r in result.differences.collect()}
    assert gaps == {"grounded": 0.0, "relevant": 1.0, "tone": 0.0, "actionable": 2.0}
    assert result.kappas.count() == 4 and result.scores.count() == 4
    assert replies.judge(asked, answers).differences is None
