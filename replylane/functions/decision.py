"""Escalate-or-not with its reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from replylane.functions.rules import FlagSet


@dataclass(frozen=True)
class EscalationPolicy:
    flags: FlagSet
    escalate_by_default: tuple[str, ...]
    low_risk: tuple[str, ...]
    min_confidence: float = 0.45


# The half-cent values between 0 and 1. They are rounded by their exact binary value, which
# the JVM formatter does not do.
_HALVES = {(2 * n + 1) / 200: f"{(2 * n + 1) / 200:.2f}" for n in range(100)}


def two_decimals(value: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in _HALVES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, value), F.format_string("%.2f", value))


def _one_if(condition: Column, reason: Column) -> Column:
    return F.when(condition, F.array(reason)).otherwise(F.array().cast("array<string>"))


def with_decision(
    df: DataFrame,
    policy: EscalationPolicy,
    text_col: str = "text",
    intent_col: str = "intent",
    confidence_col: str = "confidence",
) -> DataFrame:
    """Add ``escalate`` and the ordered ``reasons`` array."""
    intent, confidence = F.col(intent_col), F.col(confidence_col)
    df = df.withColumn("_flags", policy.flags.detect(F.col(text_col)))
    by_default = intent.isin(*policy.escalate_by_default) & (F.size("_flags") == 0)
    df = df.withColumn(
        "_found",
        F.concat(
            "_flags",
            _one_if(by_default, F.concat(F.lit("intent_default_escalate:"), intent)),
            _one_if(
                confidence < policy.min_confidence,
                F.concat(F.lit("low_classifier_confidence:"), two_decimals(confidence)),
            ),
        ),
    )
    quiet = F.when(
        intent.isin(*policy.low_risk), F.concat(F.lit("low_risk_intent:"), intent)
    ).otherwise(F.lit("no_red_flags_routine_intent"))
    return (
        df.withColumn("escalate", F.size("_found") > 0)
        .withColumn("reasons", F.when(F.col("escalate"), F.col("_found")).otherwise(F.array(quiet)))
        .drop("_flags", "_found")
    )


def as_code(escalate: Column) -> Column:
    return F.when(escalate, F.lit("escalate")).otherwise(F.lit("auto"))


def from_code(code: Column) -> Column:
    return F.coalesce(code == "escalate", F.lit(False)).cast("int")
