"""Reply-quality scores: parsing, means, and agreement with people."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from replylane.functions.drafting import parse_judgement
from replylane.operators.metrics import kappa
from replylane.schemas import JUDGE_DIMENSIONS


def judged_replies(drafts: DataFrame, responses: DataFrame) -> DataFrame:
    """Drafts with the scores an outside judge returned for their ``pair_id``."""
    parsed = responses.select("pair_id", parse_judgement(F.col("response")).alias("_j"))
    joined = drafts.join(parsed, "pair_id")
    return joined.select("pair_id", "customer_clean", "draft_reply", "_j.*")


def judge_means(scores: DataFrame) -> DataFrame:
    """Mean of each dimension, unreadable answers left out."""
    averages = scores.agg(*[F.avg(d).alias(d) for d in JUDGE_DIMENSIONS])
    return _long(averages, {d: {"mean_score": F.col(d)} for d in JUDGE_DIMENSIONS})


def with_human(scores: DataFrame, human: DataFrame) -> DataFrame:
    """Pairs scored by both sides, one row per pair and dimension."""
    both = scores.join(human, "pair_id")
    values = {
        d: {"model_score": F.col(d), "human_score": F.col(f"human_{d}")} for d in JUDGE_DIMENSIONS
    }
    return _long(both, values, "pair_id")


def mean_difference(both: DataFrame) -> DataFrame:
    gap = F.abs(F.col("model_score") - F.col("human_score"))
    return both.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("n"), F.avg(gap).alias("mean_abs_diff")
    )


def judge_kappa(both: DataFrame) -> DataFrame:
    return kappa(both, "dimension", "model_score", "human_score")


def _long(df: DataFrame, values: dict, *keys: str) -> DataFrame:
    rows = [
        F.struct(F.lit(d).alias("dimension"), *[c.alias(n) for n, c in columns.items()])
        for d, columns in values.items()
    ]
    return df.select(*keys, F.explode(F.array(*rows)).alias("_d")).select(*keys, "_d.*")
