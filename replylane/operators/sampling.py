"""Exact stratified samples and splits, repeatable by a seeded digest of the row's id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from replylane.functions.text import month_of
from replylane.operators.shape import mark_lowest


def digest(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col)))


def month_sample(pairs: DataFrame, n: int, seed: int = 42, id_col: str = "pair_id") -> DataFrame:
    """About ``n`` rows, the same share of every month rounded half to even, in time order."""
    dated = pairs.where(F.col("customer_time").isNotNull()).withColumn(
        "_month", F.date_format(month_of(F.col("customer_time")), "yyyy-MM")
    )

    def quota_of(sizes: DataFrame) -> DataFrame:
        total = sizes.agg(F.sum("size").alias("total")).scalar()
        return sizes.withColumn("quota", F.bround(F.lit(float(n)) / total * F.col("size"), 0))

    marked = mark_lowest(
        dated, "_month", digest(id_col, seed), F.col(id_col), quota_of, "_taken"
    )
    return marked.where("_taken").drop("_taken", "_month").orderBy("customer_time", id_col)


def quota_sample(
    df: DataFrame, label_col: str, quotas: dict[str, int], seed: int = 42,
    id_col: str = "pair_id",
) -> DataFrame:
    """Up to the given number of rows per label, in shuffled order.

    The literal limit lets every map task drop all but its best rows before the shuffle.
    """
    most = max(quotas.values())
    quota = F.create_map(*[F.lit(x) for pair in quotas.items() for x in pair])
    order = F.row_number().over(W.partitionBy(label_col).orderBy(digest(id_col, seed), id_col))
    ranked = df.where(F.col(label_col).isin(*quotas)).withColumn("_rank", order)
    ranked = ranked.where(F.col("_rank") <= most)
    kept = ranked.where(F.col("_rank") <= F.try_element_at(quota, F.col(label_col)))
    return kept.drop("_rank").orderBy(digest(id_col, seed + 1), id_col)


def stratified_split(
    df: DataFrame, label_col: str, fraction: float = 0.1, seed: int = 42,
    id_col: str = "pair_id", out: str = "is_validation",
) -> DataFrame:
    """Flag ``ceil(fraction * n)`` validation rows, the labels' shares kept.

    Training rows are handed out by largest remainder, ties to the lower label.
    """

    def quota_of(sizes: DataFrame) -> DataFrame:
        everything = W.partitionBy()  # over one row per label
        exact = F.col("size").cast("decimal(38,0)")
        total = F.sum("size").over(everything)
        sized = sizes.withColumn("_total", total.cast("decimal(19,0)"))
        training = F.col("_total") - F.ceil(F.lit(fraction) * F.col("_total").cast("double"))
        sized = sized.withColumn("_training", training.cast("decimal(19,0)"))
        product = F.col("size").cast("decimal(19,0)") * F.col("_training")
        sized = sized.withColumn("_left", product % F.col("_total"))
        whole = ((product - F.col("_left")) / F.col("_total")).cast("long")
        sized = sized.withColumn("_whole", whole)
        rank = F.row_number().over(W.orderBy(F.desc("_left"), F.asc(label_col)))
        spare = F.col("_training").cast("long") - F.sum("_whole").over(everything)
        sized = sized.withColumn("_rank", rank).withColumn("_spare", spare)
        given = F.col("_whole") + F.when(F.col("_rank") <= F.col("_spare"), 1).otherwise(0)
        return sized.select(label_col, (exact.cast("long") - given).alias("quota"))

    return mark_lowest(df, label_col, digest(id_col, seed), F.col(id_col), quota_of, out)


def first_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def exclude_ids(df: DataFrame, ids: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """Rows whose id is not listed; null ids on either side never match, so they stay."""
    return df.join(ids.select(id_col), id_col, "left_anti")
