"""Golden-set template, label merge, integrity checks and review overrides."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from replylane.functions.text import is_blank, strip
from replylane.operators.sampling import quota_sample
from replylane.operators.shape import keep_first
from replylane.schemas import GOLDEN

LABEL_COLUMNS = ("gold_intent", "gold_escalate", "gold_reason")


def golden_template(
    labelled: DataFrame, quotas: dict[str, int], seed: int = 42, label_col: str = "weak_intent"
) -> DataFrame:
    """Quota sample with empty label columns, for people to fill in."""
    sample = quota_sample(labelled, label_col, quotas, seed)
    sample = sample.withColumnRenamed(label_col, "weak_intent_reference_only")
    for name in (*LABEL_COLUMNS, "labeled_by"):
        sample = sample.withColumn(name, F.lit(""))
    return sample.select(*GOLDEN.names)


def missing_labels(template: DataFrame, labels: DataFrame) -> DataFrame:
    return template.select("pair_id").join(labels.select("pair_id"), "pair_id", "left_anti")


def stale_labels(template: DataFrame, labels: DataFrame) -> DataFrame:
    return labels.select("pair_id").join(template.select("pair_id"), "pair_id", "left_anti")


def merge_labels(
    template: DataFrame, labels: DataFrame, labeled_by: str, check: bool = True
) -> DataFrame:
    """Fill the template from the labels; with ``check`` a row without label, or with two, is an error.

    Without, of repeated labels of a row the least stands.
    """
    if check:
        lacking = missing_labels(template, labels)
        first = [r["pair_id"] for r in lacking.orderBy("pair_id").limit(10).collect()]
        if first:
            raise ValueError(f"{lacking.count()} pair ids have no gold label: {first}")
        repeated = labels.groupBy("pair_id").count().where("count > 1")
        first = [r["pair_id"] for r in repeated.orderBy("pair_id").limit(10).collect()]
        if first:
            raise ValueError(f"pair ids with more than one gold label: {first}")
    bare = template.drop(*LABEL_COLUMNS, "labeled_by")
    one = labels.groupBy("pair_id").agg(F.min(F.struct(*LABEL_COLUMNS)).alias("_label"))
    merged = bare.join(one.select("pair_id", "_label.*"), "pair_id")
    return merged.withColumn("labeled_by", F.lit(labeled_by)).select(*GOLDEN.names)


def apply_reviews(golden: DataFrame, reviews: DataFrame, reviewer: str = "human_review") -> DataFrame:
    """The latest review of a row replaces what it fills in; blanks keep the stored value.

    A row that was looked at carries the reviewer's tag even if nothing changed. Reviews
    with the same time are ordered by their content, so that the outcome is repeatable.
    """
    newest_first = F.struct(
        (-F.unix_micros("reviewed_at")).alias("at"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in LABEL_COLUMNS],
    )
    latest = keep_first(reviews.select("pair_id", *LABEL_COLUMNS, "reviewed_at"), "pair_id", newest_first)
    fresh = latest.select("pair_id", *[F.col(c).alias(f"new_{c}") for c in LABEL_COLUMNS], F.lit(True).alias("_seen"))
    joined = golden.join(fresh, "pair_id", "left")
    for name in LABEL_COLUMNS:
        new = strip(F.col(f"new_{name}"))
        joined = joined.withColumn(name, F.coalesce(F.nullif(new, F.lit("")), F.col(name)))
    tag = F.when(F.col("_seen"), F.lit(reviewer)).otherwise(F.col("labeled_by"))
    return joined.withColumn("labeled_by", tag).select(*golden.columns)


def unlabelled(golden: DataFrame) -> DataFrame:
    return golden.where(is_blank(F.col("gold_intent")))
