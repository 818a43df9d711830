"""Customer/agent pairs from raw messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replylane.functions.text import clean_text, parse_message_time
from replylane.operators.shape import dense_index, join_unique, keep_first, lowest_rows, may_hold
from replylane.schemas import PAIR
from replylane.staging import stage


def reply_pairs(
    messages: DataFrame, brand: str, ordinal: Column, first_turn_only: bool = False,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Every brand message whose parent exists and is inbound, beside that parent.

    Of messages sharing an id the lowest ``ordinal``, which no two of them share, stands; only
    then is the parent tested for being inbound. With ``first_turn_only`` the parent must itself open the thread, and
    its earliest reply is kept.
    """
    replies = stage(messages.where(
        (F.col("author_id") == brand) & F.col("reply_to_id").isNotNull()
    ).select(
        F.col("reply_to_id").alias("_parent"),
        F.col("message_id").alias("agent_message_id"),
        F.col("text").alias("agent_text"),
        F.col("created_at").alias("agent_time"),
    ), "replies")
    # What is not inbound can only hide a later copy, so its text need not travel.
    numbered = messages.select(
        F.col("message_id").alias("customer_message_id"),
        F.when(F.col("inbound"), F.col("text")).alias("customer_text"),
        F.when(F.col("inbound"), F.col("created_at")).alias("_created_at"),
        F.col("reply_to_id").alias("_above"),
        "inbound",
        ordinal.alias("_ordinal"),
    )
    # Few messages are parents of the brand's replies: a filter of the asked ids lets these
    # through while the dump is read, and what it lets through is written and read from there.
    asked = stage(may_hold(numbered, "customer_message_id", replies, "_parent"), "asked-messages")
    parents = lowest_rows(asked, "customer_message_id", "_ordinal").where("inbound")
    if first_turn_only:
        parents = parents.where(F.col("_above").isNull())
        at = F.struct(
            parse_message_time(F.col("agent_time")).isNull(),
            parse_message_time(F.col("agent_time")), "agent_message_id",
        )
        replies = keep_first(replies, "_parent", at)
        replies = stage(replies, "first-replies")
    parents = stage(parents.select("customer_message_id", "customer_text", "_created_at"), "parents")
    joined = join_unique(replies, parents, "_parent", "customer_message_id", hot_rows)
    return joined.drop("_parent")


def clean_pairs(pairs: DataFrame, min_length: int = 8) -> DataFrame:
    """Clean both texts, drop short customer messages, parse the customer's time."""
    return (
        pairs.withColumn("customer_clean", clean_text(F.col("customer_text")))
        .where(F.length("customer_clean") >= min_length)
        .withColumn("agent_clean", clean_text(F.col("agent_text")))
        .withColumn("customer_time", parse_message_time(F.col("_created_at")))
        .drop("_created_at")
    )


def number_pairs(pairs: DataFrame, prefix: str) -> DataFrame:
    """``PREFIX-000000`` ids in time order, times that did not parse last.

    The rows are written first: a range sort reads its input twice, to find the ranges and
    to sort, and the join above should run once.
    """
    keys = [
        F.col("customer_time").asc_nulls_last(),
        F.col("customer_message_id").asc(),
        F.col("agent_message_id").asc(),
    ]
    numbered = dense_index(stage(pairs, "clean-pairs"), keys, "_n")
    pair_id = F.format_string(f"{prefix}-%06d", F.col("_n"))
    return numbered.withColumn("pair_id", pair_id).select(*PAIR.names)


def build_pairs(
    messages: DataFrame, brand: str, prefix: str, ordinal: Column, min_length: int = 8,
    first_turn_only: bool = False,
) -> DataFrame:
    pairs = reply_pairs(messages, brand, ordinal, first_turn_only)
    return number_pairs(clean_pairs(pairs, min_length), prefix)
