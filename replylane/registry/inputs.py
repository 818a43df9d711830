"""How the given tables stand in for support data.

A conversation is a thread: user turns are inbound messages, assistant turns are the brand's
replies to the turn before. The invented prose holds no support vocabulary, so each user turn
also carries one of the phrases below, chosen by its key. The whole text stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from replylane.functions.decision import EscalationPolicy
from replylane.functions.rules import FlagSet, RuleSet
from replylane.functions.text import clean_text
from replylane.operators.pairs import build_pairs
from replylane.operators.retrieval import CaseIndex
from replylane.operators.sampling import exclude_ids, quota_sample, stratified_split
from replylane.packs import airline
from replylane.plans.training import IntentModel, fit_intent_model, train_on_rules
from replylane.plans.triage import Desk
from replylane.session import pin_runtime
from replylane.staging import stage

BRAND = "acme_air"
PREFIX = "ACME"
LOYALTY = "AcmeMiles"

PHRASES = (
    "please refund the ticket you sold me",
    "will you reimburse the hotel &amp; taxi",
    "I want compensation for the wasted day",
    "why was I charged for a seat twice",
    "my bag is lost and nobody answers",
    "our bags came out damaged again",
    "a suitcase went missing on the way",
    "nobody was at baggage claim",
    "the flight is delayed, third time this month",
    "you cancelled on us and we missed connection home",
    "we are stuck on the plane for hours",
    "sitting here on the tarmac, no crew in sight",
    "they want to rebook us for another flight",
    "cannot check-in with my phone",
    "where is my boarding pass",
    "the app won’t load my trip",
    "I can’t book the flight I need",
    "no upgrade although I hold gold status",
    "my AcmeMiles balance is off, miles are missing",
    "platinum member here, upgrade list makes no sense",
    "thanks so much for the quick help",
    "kudos to the crew of this trip \U0001F600",
    "great service today, well done",
    "I appreciate the kind agent at the desk",
    "the agent was rude to my mother",
    "this is unacceptable, I call my lawyer",
    "worst airline ever",
    "disgusting cabin, never fly again with you",
    "ridiculous and pathetic handling",
    "the staff let down every single guest",
    "any chance to get an aisle seat",
    "what time does the lounge open?",
    "is there food on board?",
    "how long is the walk to the gate?",
    "can I bring a stroller",
    "there was a medical emergency on board",
    "I feel unsafe with this airline",
    "use code &lt;SPRING&gt; they said",
    "it&#39;s all about the view up here",
    "see you tomorrow",
)

LANGUAGE_RULES = RuleSet(
    (
        ("de", (r"\b(der|die|und|nicht)\b",)),
        ("es", (r"\b(que|los|las|una)\b",)),
        ("fr", (r"\b(une|pour|les|est)\b",)),
        ("en", (r"\b(the|and|that)\b",)),
    ),
    "unknown",
)
INSULTS = (("insult", r"\b(disgust\w*|pathetic|idiot|stupid)\b"),)
LANGUAGES = ("en", "fr", "de", "es", "unknown")

#: golden rows per language; documents are many enough to hold out all of them
LANGUAGE_QUOTAS = {"en": 25, "fr": 22, "de": 22, "es": 22, "unknown": 20}
RULES = airline.rules(LOYALTY)
LANGUAGE_POLICY = EscalationPolicy(FlagSet(INSULTS), (), (), min_confidence=0.0)
DESK = Desk(airline.policy(), airline.templates(LOYALTY), airline.DEFAULT_INTENT, BRAND)

_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build):
    """Inputs that several queries share are written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_runtime(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_rows(turns: DataFrame) -> DataFrame:
    """Conversation turns, batch or stream, as an all-text message dump with an ordinal."""
    is_user = F.col("role") == "user"
    n = (F.col("conv_id") * 7 + F.col("turn")) % len(PHRASES)
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (n + 1).cast("int"))
    first, second = F.concat_ws(" ", phrase, "text"), F.concat_ws(" ", "text", phrase)
    mixed = F.when(F.col("turn") % 3 == 0, first).otherwise(second)
    link = F.concat(F.lit(" https://acme.example/t/"), F.col("conv_id"))
    text = F.when(is_user, F.concat(F.lit(f"@{BRAND} "), mixed, link)).otherwise(F.col("text"))
    key = F.col("conv_id") * 1000 + F.col("turn")
    return turns.select(
        key.cast("string").alias("message_id"),
        F.when(F.col("role") == "assistant", F.lit(BRAND))
        .otherwise(F.concat("role", F.lit("-"), "conv_id")).alias("author_id"),
        F.when(is_user, F.lit("True")).otherwise(F.lit("False")).alias("inbound"),
        _created_at().alias("created_at"),
        text.alias("text"),
        F.when(F.col("turn") > 0, (key - 1).cast("string")).alias("reply_to_id"),
        key.alias("ordinal"),
    )


def _created_at() -> Column:
    """Spread over eight months; one conversation in 41 has an unreadable time."""
    day = (F.col("conv_id") * 37) % 240
    seconds = day * 86400 + (F.col("conv_id") % 1440) * 60 + F.col("turn") * 61
    at = F.timestamp_seconds(F.lit(1483430400) + seconds)
    text = F.concat(
        F.date_format(at, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(at, "yyyy")
    )
    return F.when(F.col("conv_id") % 41 == 7, F.lit("some day in spring")).otherwise(text)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_rows(table(spark, sf_dir, "conversations"))
    return raw.withColumn("inbound", F.col("inbound") == "True")


def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned inbound messages as (id, text, confidence), the last one derived from the id."""
    inbound = messages(spark, sf_dir).where("inbound")
    return inbound.select(
        F.col("message_id").alias("id"),
        clean_text(F.col("text")).alias("text"),
        (((F.col("ordinal") * 13) % 200).cast("double") / 200).alias("confidence"),
    )


def rule_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = customer_messages(spark, sf_dir)
    return asked.withColumn("intent", RULES.label(F.col("text")))


def labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs with their weak intent, labelled once and stored."""
    def build() -> DataFrame:
        dump = messages(spark, sf_dir)
        built = build_pairs(dump, BRAND, PREFIX, F.col("ordinal"), airline.MIN_CUSTOMER_LENGTH)
        labelled = built.withColumn("weak_intent", RULES.label(F.col("customer_clean")))
        return stage(labelled, "pairs")

    return _once(pin_runtime(spark), sf_dir, "pairs", build)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_pairs(spark, sf_dir).drop("weak_intent")


def case_index(spark: SparkSession, sf_dir: str) -> CaseIndex:
    return _once(
        spark, sf_dir, "index",
        lambda: CaseIndex.build(
            labelled_pairs(spark, sf_dir), min_reply_length=airline.MIN_REPLY_LENGTH
        ),
    )


def gold_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold label for every pair: the weak one, but for each fifth pair the next in line."""
    n = F.substring("pair_id", len(PREFIX) + 2, 18).cast("long")
    names = F.array(*[F.lit(i) for i in airline.INTENTS])
    other = F.element_at(names, (n % len(airline.INTENTS) + 1).cast("int"))
    return labelled_pairs(spark, sf_dir).select(
        "pair_id",
        F.when(n % 5 == 0, other).otherwise(F.col("weak_intent")).alias("gold_intent"),
        F.when(n % 3 == 0, F.lit("escalate")).otherwise(F.lit("auto")).alias("gold_escalate"),
        F.concat(F.lit("case "), n % 7).alias("gold_reason"),
    )


def model(spark: SparkSession, sf_dir: str) -> IntentModel:
    """The triage classifier. It is never scored on these pairs, so none is held out."""
    def build() -> IntentModel:
        labelled = labelled_pairs(spark, sf_dir)
        return train_on_rules(labelled.drop("weak_intent"), RULES, labelled.limit(0))[0]

    return _once(spark, sf_dir, "model", build)


def language_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows to classify: the weak label is the rules' guess, the gold one ``lang``."""
    def build() -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        toxic = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        decision = F.when(F.col("toxic") == 1, "escalate").otherwise("auto")
        rows = docs.join(toxic, "doc_id", "left").select(
            F.col("doc_id").cast("string").alias("pair_id"), F.col("text").alias("customer_clean"),
            LANGUAGE_RULES.label(F.col("text")).alias("weak_intent"),
            F.col("lang").alias("gold_intent"), decision.alias("gold_escalate"),
        )
        return stage(rows, "languages")

    return _once(pin_runtime(spark), sf_dir, "languages", build)


def language_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out rows: a full quota of each language, as the rules see it."""
    build = lambda: stage(
        quota_sample(language_rows(spark, sf_dir), "weak_intent", LANGUAGE_QUOTAS), "golden"
    )
    return _once(spark, sf_dir, "golden", build)


def language_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows outside the golden set, with ``is_validation``."""
    def build() -> DataFrame:
        rows = language_rows(spark, sf_dir).select("pair_id", "customer_clean", "weak_intent")
        kept = stage(exclude_ids(rows, language_golden(spark, sf_dir)), "kept")
        return stage(stratified_split(kept, "weak_intent"), "split")

    return _once(spark, sf_dir, "split", build)


def language_model(spark: SparkSession, sf_dir: str) -> IntentModel:
    def build() -> IntentModel:
        rows = language_training(spark, sf_dir).where(~F.col("is_validation"))
        return fit_intent_model(rows, "customer_clean", "weak_intent")

    return _once(spark, sf_dir, "language_model", build)


def documents_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their true language and the rule pack's guess."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", "source", LANGUAGE_RULES.label(F.col("text")).alias("guess"))
