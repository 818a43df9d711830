from pyspark.sql import functions as F

from replylane.functions.decision import two_decimals, with_decision
from replylane.packs import airline


def decide(spark, rows):
    df = spark.createDataFrame(rows, "text string, intent string, confidence double")
    df = df.withColumn("i", F.monotonically_increasing_id())
    out = with_decision(df, airline.policy()).orderBy("i").collect()
    return [(r["escalate"], r["reasons"]) for r in out]


def test_truth_table(spark):
    got = decide(spark, [
        ("hello", "flight_disruption", 0.9),
        ("hello", "service_complaint", 0.9),
        ("again", "service_complaint", 0.9),
        ("hello", "service_complaint", 0.2),
        ("again, a voucher", "info_question", 0.44),
        ("hello", "praise_thanks", 0.9),
        ("hello", "praise_thanks", 0.3),
        ("again", "praise_thanks", 0.9),
        ("hello", "info_question", 0.45),
        ("hello", "refund_compensation_request", 0.45),
    ])
    assert got == [
        (False, ["no_red_flags_routine_intent"]),
        (True, ["intent_default_escalate:service_complaint"]),
        (True, ["repeated_failure"]),
        (True, ["intent_default_escalate:service_complaint", "low_classifier_confidence:0.20"]),
        (True, ["repeated_failure", "explicit_compensation_or_refund",
                "low_classifier_confidence:0.44"]),
        (False, ["low_risk_intent:praise_thanks"]),
        (True, ["low_classifier_confidence:0.30"]),
        (True, ["repeated_failure"]),
        (False, ["no_red_flags_routine_intent"]),
        (True, ["intent_default_escalate:refund_compensation_request"]),
    ]


def test_two_decimals_round_like_the_binary_value(column):
    values = [n / 1000 for n in range(0, 1001)]
    assert column(values, two_decimals, "double") == [f"{v:.2f}" for v in values]
