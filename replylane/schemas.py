"""Fixed schemas; nothing here is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


RAW_CSV = T.StructType(
    _strings("message_id", "author_id", "inbound", "created_at", "text", "reply_to_id")
)

RAW_MESSAGE = T.StructType(
    _strings("message_id", "author_id")
    + [T.StructField("inbound", T.BooleanType())]
    + _strings("created_at", "text", "reply_to_id")
)

PAIR = T.StructType(
    _strings("pair_id", "customer_message_id", "customer_text")
    + [T.StructField("customer_time", T.TimestampType())]
    + _strings("agent_message_id", "agent_text", "agent_time", "customer_clean", "agent_clean")
)

GOLDEN = T.StructType(
    _strings("pair_id", "customer_clean", "agent_clean", "weak_intent_reference_only")
    + [T.StructField("customer_time", T.TimestampType())]
    + _strings("gold_intent", "gold_escalate", "gold_reason", "labeled_by")
)

GOLD_LABEL = T.StructType(_strings("pair_id", "gold_intent", "gold_escalate", "gold_reason"))

REVIEW = T.StructType(
    _strings("pair_id", "gold_intent", "gold_escalate", "gold_reason")
    + [T.StructField("reviewed_at", T.TimestampType())]
)

JUDGE_DIMENSIONS = ("grounded", "relevant", "tone", "actionable")

JUDGE_RESPONSE = T.StructType(
    [T.StructField(d, T.DoubleType()) for d in JUDGE_DIMENSIONS] + _strings("notes")
)

RULE = T.StructType(
    [T.StructField("priority", T.IntegerType())] + _strings("label", "pattern")
)

FLAG = T.StructType([T.StructField("position", T.IntegerType())] + _strings("name", "pattern"))
