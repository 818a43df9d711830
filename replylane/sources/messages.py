"""Message and table sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from replylane.functions.text import month_of, null_if_token
from replylane.schemas import RAW_CSV, RAW_MESSAGE


def read_message_csv(
    spark: SparkSession, path: str, renames: dict[str, str] | None = None
) -> DataFrame:
    """Raw messages from CSV: all text, quoted newlines, doubled quotes, null tokens.

    Columns are picked by their name in the header, and no type is inferred; ``renames``
    maps the file's names to ours. A multi-line file cannot be split, so feed many files, or
    convert a single big dump to parquet once.
    """
    theirs = {ours: name for name, ours in (renames or {}).items()}
    reader = spark.read.option("header", True).option("multiLine", True)
    raw = reader.option("quote", '"').option("escape", '"').csv(path)
    picked = [F.col(theirs.get(n, n)).cast("string").alias(n) for n in RAW_CSV.names]
    return cast_messages(raw.select(*picked))


def cast_messages(raw: DataFrame) -> DataFrame:
    """All-text rows to the message schema; ``inbound`` is true for the exact text True."""
    columns = {name: null_if_token(F.col(name)) for name in RAW_CSV.names}
    columns["inbound"] = F.coalesce(F.col("inbound") == "True", F.lit(False))
    return raw.select(*[columns[name].alias(name) for name in RAW_MESSAGE.names])


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_table(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
    observation: Observation | None = None,
) -> None:
    """Write parquet; an observation carries the row count of the same pass."""
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_pairs(df: DataFrame, path: str, observation: Observation | None = None) -> None:
    """Pairs partitioned by the month of the customer's message, for partition pruning.

    Rebalancing by month keeps the number of files low, and splits a month that is large.
    """
    monthly = df.withColumn("month", F.date_format(month_of(F.col("customer_time")), "yyyy-MM"))
    write_table(monthly.hint("rebalance", F.col("month")), path, ("month",), observation)


def write_metadata(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)
