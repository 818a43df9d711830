"""Classification metrics as grouped counts.

Everything starts from one count per (group, truth, prediction); what follows works on a
table no larger than groups x labels squared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replylane.operators.shape import inline


def label_distribution(df: DataFrame, label_col: str, taxonomy: list[str]) -> DataFrame:
    """Count and share of every taxonomy label, zeros included, in taxonomy order."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    listed = inline(df, list(enumerate(taxonomy)), ["position", label_col])
    n = F.coalesce("n", F.lit(0))
    return (
        listed.join(counts, label_col, "left")
        .select("position", label_col, n.alias("n"), F.try_divide(n, total).alias("share"))
        .orderBy("position")
    )


def value_counts(df: DataFrame, label_col: str) -> DataFrame:
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), label_col)


def rate(condition: Column) -> Column:
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def agreement_rate(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.agg(rate(F.col(left) == F.col(right)).alias("agreement"))


def majority_label(df: DataFrame, label_col: str) -> Column:
    """The most frequent label as a scalar; ties go to the lower label."""
    return value_counts(df, label_col).limit(1).select(label_col).scalar()


def stack_systems(df: DataFrame, truth: str, systems: dict[str, Column]) -> DataFrame:
    """One row per message and predictor: system, truth, pred."""
    rows = [
        F.struct(F.lit(name).alias("system"), pred.alias("pred")) for name, pred in systems.items()
    ]
    stacked = df.select(F.col(truth).alias("truth"), F.explode(F.array(*rows)).alias("_s"))
    return stacked.select("_s.system", "truth", "_s.pred")


def confusion_counts(df: DataFrame, truth: str, pred: str, by: str | None = None) -> DataFrame:
    keys = [by] if by else []
    return df.groupBy(*keys, F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_label(counts: DataFrame, by: str | None = None) -> DataFrame:
    """Precision, recall, F1 and support of every label in truth or predictions."""
    keys = [by] if by else []
    sides = F.array(
        F.struct(
            F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
            F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    long = counts.select(*keys, F.explode(sides).alias("_s")).select(*keys, "_s.*")
    sums = long.groupBy(*keys, "label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return sums.select(
        *keys, "label",
        _ratio(hits, predicted).alias("precision"),
        _ratio(hits, support).alias("recall"),
        _ratio(2 * hits, support + predicted).alias("f1"),
        "support", "hits",
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def intent_scores(df: DataFrame, truth: str, pred: str, by: str) -> DataFrame:
    """Accuracy and macro-F1 of each system or stratum."""
    labels = per_label(confusion_counts(df, truth, pred, by), by)
    return labels.groupBy(by).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("macro_f1")
    )


def class_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Per-label rows and the accuracy, macro and weighted summary rows."""
    labels = per_label(confusion_counts(df, truth, pred))
    measures = ("precision", "recall", "f1")
    accuracy = F.sum("hits") / F.sum("support")
    weighted = {m: F.sum(F.col(m) * F.col("support")) / F.sum("support") for m in measures}
    summary = labels.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("label"), *[accuracy.alias(m) for m in measures],
                F.sum("support").alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in measures],
                F.sum("support").alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("label"), *[weighted[m].alias(m) for m in measures],
                F.sum("support").alias("support"),
            ),
        ).alias("_rows")
    ).select(F.explode("_rows").alias("_r")).select("_r.*")
    return labels.drop("hits").unionByName(summary)


def confusion_matrix(
    df: DataFrame, truth: str, pred: str, labels: list[str], other: str | None = None
) -> DataFrame:
    """One row per true label, one column per predicted label, zeros included.

    With ``other``, labels that are not listed count under that name; without, pairs of labels
    of which one is not listed are left out.
    """
    if other is not None:
        named = {c: F.when(F.col(c).isin(*labels), F.col(c)).otherwise(other) for c in (truth, pred)}
        df, labels = df.withColumns(named), [*labels, other]
    counts = confusion_counts(df, truth, pred)
    wide = counts.groupBy("truth").pivot("pred", labels).agg(F.sum("n"))
    listed = inline(df, [(label,) for label in labels], ["truth"])
    return listed.join(wide, "truth", "left").fillna(0, subset=labels)


def binary_scores(df: DataFrame, truth: str, pred: str, by: str) -> DataFrame:
    """Precision, recall and F1 of the positive class of 0/1 columns, zero if undefined."""
    hit = F.sum(((F.col(truth) == 1) & (F.col(pred) == 1)).cast("long"))
    positives = F.sum((F.col(truth) == 1).cast("long"))
    claimed = F.sum((F.col(pred) == 1).cast("long"))
    sums = df.groupBy(by).agg(
        hit.alias("_hit"), positives.alias("_positives"), claimed.alias("_claimed")
    )
    return sums.select(
        by,
        _ratio(F.col("_hit"), F.col("_claimed")).alias("precision"),
        _ratio(F.col("_hit"), F.col("_positives")).alias("recall"),
        _ratio(2 * F.col("_hit"), F.col("_positives") + F.col("_claimed")).alias("f1"),
    )


def stratum_accuracy(df: DataFrame, truth: str, pred: str, stratum: str) -> DataFrame:
    return df.groupBy(stratum).agg(
        F.count(F.lit(1)).alias("n"), rate(F.col(truth) == F.col(pred)).alias("accuracy")
    )


def correctness_flags(df: DataFrame) -> DataFrame:
    same = {
        "intent_correct": F.col("gold_intent") == F.col("pred_intent"),
        "escalate_correct": F.col("gold_escalate") == F.col("pred_escalate"),
    }
    return df.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in same.items()})


def kappa(df: DataFrame, dimension: str, left: str, right: str) -> DataFrame:
    """Cohen's kappa per dimension of two raters' scores; null where chance agreement is 1."""
    rated = df.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    joint = rated.groupBy(dimension, F.col(left).alias("a"), F.col(right).alias("b")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Chance agreement needs both marginals of a score, also where the pair never occurs.
    sides = joint.select(
        dimension,
        F.explode(F.array(
            F.struct(F.col("a").alias("s"), F.col("n").alias("left_n"), F.lit(0).cast("long").alias("right_n")),
            F.struct(F.col("b").alias("s"), F.lit(0).cast("long").alias("left_n"), F.col("n").alias("right_n")),
        )).alias("_s"),
    ).select(dimension, "_s.*")
    marginals = sides.groupBy(dimension, "s").agg(
        F.sum("left_n").alias("left_n"), F.sum("right_n").alias("right_n")
    )
    by_chance = marginals.groupBy(dimension).agg(
        (
            F.sum(F.col("left_n").cast("double") * F.col("right_n"))
            / (F.sum("left_n").cast("double") * F.sum("right_n"))
        ).alias("_pe")
    )
    agreed = joint.groupBy(dimension).agg(
        F.sum("n").alias("n"),
        (F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)) / F.sum("n")).alias("_po"),
    )
    value = F.try_divide(F.col("_po") - F.col("_pe"), 1 - F.col("_pe"))
    return agreed.join(by_chance, dimension).select(
        dimension, "n", F.col("_po").alias("agreement"), value.alias("kappa")
    )
