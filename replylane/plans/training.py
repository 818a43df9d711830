"""Weakly supervised training of the intent classifier, and batch scoring with it."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from replylane.functions.rules import RuleSet
from replylane.operators.metrics import rate
from replylane.operators.regression import Regression, fit, packed
from replylane.operators.sampling import exclude_ids, stratified_split
from replylane.operators.tfidf import MAX_FEATURES, TfidfModel
from replylane.staging import stage

MAX_LABELS = 10_000
#: entries of vectors in one task of the fit
ENTRIES_PER_TASK = 250_000


@dataclass(frozen=True)
class IntentModel:
    """Vectoriser, multinomial regression, and the labels by class index (ascending)."""

    vectors: TfidfModel
    regression: Regression
    labels: tuple[str, ...]

    def classify(self, df: DataFrame, text_col: str = "text", vector_col: str | None = None) -> DataFrame:
        """Add ``intent`` and ``confidence``; row-local, so streams can use it too.

        Of equally likely labels the alphabetically first wins. ``vector_col`` names a column that
        keeps the vector.
        """
        features = vector_col or "features"
        scored = self.vectors.with_vector(df, text_col, features)
        scored = scored.withColumn("_p", self.regression.probabilities(F.col(features)))
        names = F.array(*[F.lit(label) for label in self.labels])
        best = F.array_position("_p", F.array_max("_p"))
        scored = scored.withColumn("intent", F.element_at(names, best.cast("int")))
        scored = scored.withColumn("confidence", F.array_max("_p"))
        return scored.select(*df.columns, "intent", "confidence", *([vector_col] if vector_col else []))

    def top_terms(self, spark: SparkSession, n: int) -> DataFrame:
        """The ``n`` heaviest n-grams of each label.

        Starts from the coefficient matrix, labels x vocabulary, which the model holds anyway.
        """
        weights = self.regression.coefficientMatrix.toArray()
        terms = self.vectors.terms
        table = pa.table({
            "label": pa.array([l for l in self.labels for _ in terms], pa.string()),
            "term": pa.array(terms * len(self.labels), pa.string()),
            "weight": pa.array(weights.ravel(), pa.float64()),
        })
        rank = F.row_number().over(W.partitionBy("label").orderBy(F.desc("weight"), "term"))
        ranked = spark.createDataFrame(table).withColumn("rank", rank)
        return ranked.where(F.col("rank") <= n)

    def save(self, spark: SparkSession, path: str) -> None:
        self.vectors.save(spark, f"{path}/vocabulary")
        self.regression.save(spark, f"{path}/regression")
        labels = pa.table({"position": list(range(len(self.labels))), "label": list(self.labels)})
        spark.createDataFrame(labels).coalesce(1).write.mode("overwrite").parquet(f"{path}/labels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IntentModel":
        rows = sorted(spark.read.parquet(f"{path}/labels").collect(), key=lambda r: r["position"])
        return cls(
            TfidfModel.load(spark, f"{path}/vocabulary"),
            Regression.load(spark, f"{path}/regression"),
            tuple(r["label"] for r in rows),
        )


def in_blocks(
    vectors: DataFrame, entries: int = ENTRIES_PER_TASK, filled: Column | None = None
) -> DataFrame:
    """Written vectors in as many partitions as their non-zero entries ask for.

    Every step of the fit is a job over these: tasks should have enough to do, and a few long
    texts are as much work as many short ones. ``filled`` counts a row's entries.
    """
    if filled is None:
        filled = F.size(F.unwrap_udt("features")["indices"])
    n = vectors.agg(F.sum(filled)).first()[0] or 0
    return vectors.repartition(max(1, math.ceil(n / entries)))


def fit_intent_model(
    train: DataFrame, text_col: str, label_col: str, max_features: int = MAX_FEATURES,
    min_df: int = 2, strength: float = 2.0, max_iter: int = 1000,
    tolerance: float = 1e-6,
) -> IntentModel:
    """Balanced multinomial regression on damped TF-IDF, inverse L2 strength ``strength``."""
    sizes = train.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    rows = sorted(sizes.limit(MAX_LABELS + 1).collect(), key=lambda r: r[label_col])
    if not 2 <= len(rows) <= MAX_LABELS:
        raise ValueError(f"training needs 2 to {MAX_LABELS} labels, found {len(rows)}")
    total = sum(r["n"] for r in rows)
    labels = tuple(r[label_col] for r in rows)
    balance = F.array(*[F.lit(total / (len(rows) * r["n"])) for r in rows])

    vectors = TfidfModel.fit(train, text_col, max_features, min_df, sublinear=True)
    position = F.array_position(F.array(*[F.lit(label) for label in labels]), F.col(label_col))
    placed = train.select(text_col, position.cast("int").alias("_at"))
    ready = vectors.with_vector(placed, text_col, "features").select(
        "features",
        (F.col("_at") - 1).alias("label"),
        F.element_at(balance, F.col("_at")).alias("weight"),
    )
    # The balanced weights sum to the row count, so the penalty is 1 / (C * sum of weights).
    regression = fit(
        packed(ready, "features", "label", "weight"), len(labels), len(vectors.idf), total,
        1.0 / (strength * total), max_iter, tolerance,
    )
    return IntentModel(vectors, regression, labels)


def train_on_rules(
    pairs: DataFrame, rules: RuleSet, golden_ids: DataFrame, fraction: float = 0.1,
    seed: int = 42, text_col: str = "customer_clean", **fit_options,
) -> tuple[IntentModel, DataFrame]:
    """Label by rules, drop golden ids, split, fit; returns the model and its metadata row."""
    labelled = pairs.select("pair_id", text_col, rules.label(F.col(text_col)).alias("weak_intent"))
    kept = exclude_ids(labelled, golden_ids)
    split = stage(stratified_split(kept, "weak_intent", fraction, seed), "split")
    train = split.where(~F.col("is_validation"))
    model = fit_intent_model(train, text_col, "weak_intent", **fit_options)
    return model, training_metadata(model, split, text_col)


def training_metadata(model: IntentModel, split: DataFrame, text_col: str) -> DataFrame:
    """Accuracy against the held-out weak labels, and the number of training rows."""
    scored = model.classify(split.where("is_validation"), text_col)
    accuracy = scored.agg(rate(F.col("intent") == F.col("weak_intent")).alias("a")).scalar()
    n_train = F.sum((~F.col("is_validation")).cast("long")).alias("n_train")
    return split.agg(n_train).select(accuracy.alias("held_out_weak_val_accuracy"), "n_train")
