"""The registered queries: each runs one capability over the given tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from replylane.functions import drafting, rules as rule_functions, text
from replylane.functions.decision import as_code, from_code, with_decision
from replylane.operators import golden, judging, metrics, retrieval, sampling, tfidf
from replylane.operators.pairs import clean_pairs, reply_pairs
from replylane.operators.shape import lowest_rows
from replylane.packs import airline
from replylane.plans import evaluation, training, triage as triage_plan
from replylane.registry import inputs
from replylane.sources import messages as sources
from replylane.schemas import JUDGE_DIMENSIONS
from replylane.staging import new_path, stage
from replylane.streaming import live

SECONDS = "yyyy-MM-dd HH:mm:ss"


def _r(name: str) -> Column:
    return F.round(name, 6).alias(name)


def _joined(name: str, sep: str = "|") -> Column:
    return F.array_join(name, sep).alias(name)


# --- text -----------------------------------------------------------------------------


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.table(spark, sf, "documents")
    return docs.select("doc_id", text.clean_text(F.col("text")).alias("clean"))


def html_decode(spark: SparkSession, sf: str) -> DataFrame:
    pages = inputs.table(spark, sf, "pages")
    return pages.select("page_id", text.decode_entities(F.col("html")).alias("decoded"))


def message_time(spark: SparkSession, sf: str) -> DataFrame:
    time = text.parse_message_time(F.col("created_at"))
    parsed = inputs.messages(spark, sf).select("message_id", time.alias("_t"))
    return parsed.select(
        "message_id",
        F.date_format("_t", SECONDS).alias("sent_at"),
        F.date_format(text.month_of(F.col("_t")), "yyyy-MM").alias("month"),
    )


def blank_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that are not blank once cleaned."""
    cleaned = inputs.messages(spark, sf).select(
        "message_id", text.clean_text(F.col("text")).alias("clean")
    )
    return cleaned.where(~text.is_blank(F.col("clean"))).select("message_id", F.length("clean").cast("long").alias("size"))


def ngrams(spark: SparkSession, sf: str) -> DataFrame:
    docs = text.with_terms(inputs.table(spark, sf, "documents").select("doc_id", "text"), "text")
    return docs.select(
        "doc_id",
        F.size("terms").cast("long").alias("n_terms"),
        F.md5(F.array_join("terms", "|")).alias("terms_md5"),
    )


# --- sources and sinks ----------------------------------------------------------------


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The message dump written as quoted CSV, then scanned back."""
    dump = inputs.raw_rows(inputs.table(spark, sf, "conversations")).drop("ordinal")
    path = new_path(spark, "dump")
    dump.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False, nullValue="NA",
    ).csv(path)
    return sources.read_message_csv(spark, path)


def monthly_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per month of the pairs table, written by month and read back."""
    path = new_path(spark, "pairs-by-month")
    sources.write_pairs(inputs.pairs(spark, sf), path)
    month = F.coalesce(F.col("month").cast("string"), F.lit("none"))
    return spark.read.parquet(path).groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("n"))


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts observed while the pairs were written, beside those of the dump."""
    seen = Observation("pairs")
    sources.write_table(inputs.pairs(spark, sf), new_path(spark, "counted"), observation=seen)
    dump = inputs.messages(spark, sf)
    replies = F.sum((F.col("author_id") == inputs.BRAND).cast("long"))
    return dump.agg(
        F.count(F.lit(1)).alias("messages"), replies.alias("replies"),
        F.lit(seen.get["rows"]).cast("long").alias("pairs"),
    )


# --- pairs ----------------------------------------------------------------------------


def reply_join(spark: SparkSession, sf: str) -> DataFrame:
    dump = inputs.messages(spark, sf)
    joined = clean_pairs(reply_pairs(dump, inputs.BRAND, F.col("ordinal")))
    return joined.select("customer_message_id", "agent_message_id", "customer_clean", "agent_clean")


def first_turns(spark: SparkSession, sf: str) -> DataFrame:
    dump = inputs.messages(spark, sf)
    joined = reply_pairs(dump, inputs.BRAND, F.col("ordinal"), first_turn_only=True)
    return joined.select("customer_message_id", "agent_message_id")


def pair_ids(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.pairs(spark, sf).select(
        "pair_id", "customer_message_id", "agent_message_id",
        F.date_format("customer_time", SECONDS).alias("customer_time"), "agent_time",
    )


def first_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Of documents with the same text, the one with the lowest id."""
    docs = inputs.table(spark, sf, "documents").select(F.md5("text").alias("text_md5"), "doc_id", "source")
    return lowest_rows(docs, "text_md5", "doc_id")


# --- rules and decisions --------------------------------------------------------------


def weak_label(spark: SparkSession, sf: str) -> DataFrame:
    asked = inputs.customer_messages(spark, sf)
    return asked.select(
        "id",
        inputs.RULES.label(F.col("text")).alias("weak_intent"),
        inputs.RULES.matched_rule(F.col("text")).cast("long").alias("matched_rule"),
    )


def language_label(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.documents_by_language(spark, sf).select("doc_id", "guess")


def rule_matches(spark: SparkSession, sf: str) -> DataFrame:
    """All pattern hits in long form, and the label that wins among them."""
    asked = inputs.customer_messages(spark, sf)
    hits = rule_functions.match_table(asked, "id", "text", inputs.RULES)
    counted = hits.groupBy("id").agg(F.count(F.lit(1)).alias("hits"))
    return rule_functions.first_match(hits, "id").join(counted, "id")


def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    labelled = inputs.rule_classified(spark, sf)
    table = metrics.label_distribution(labelled, "intent", list(airline.INTENTS))
    return table.select("position", "intent", "n", _r("share"))


def label_display(spark: SparkSession, sf: str) -> DataFrame:
    table = metrics.label_distribution(
        inputs.rule_classified(spark, sf), "intent", list(airline.INTENTS)
    )
    return table.select(
        text.display_label(F.col("intent")).alias("title"),
        text.display_percent(F.col("share")).alias("percent"),
    )


def red_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = inputs.DESK.policy.flags.detect(F.col("text"))
    return inputs.customer_messages(spark, sf).select("id", F.array_join(flags, "|").alias("flags"))


def escalation_decision(spark: SparkSession, sf: str) -> DataFrame:
    decided = with_decision(inputs.rule_classified(spark, sf), inputs.DESK.policy)
    return decided.select("id", "intent", "confidence", "escalate", _joined("reasons"))


def decision_counts(spark: SparkSession, sf: str) -> DataFrame:
    decided = with_decision(inputs.rule_classified(spark, sf), inputs.DESK.policy)
    return decided.groupBy("intent", "escalate").agg(F.count(F.lit(1)).alias("n"))


# --- samples and splits ---------------------------------------------------------------


def month_sample(spark: SparkSession, sf: str) -> DataFrame:
    taken = sampling.month_sample(inputs.pairs(spark, sf), 100)
    return taken.select("pair_id", F.date_format("customer_time", SECONDS).alias("customer_time"))


def quota_sample(spark: SparkSession, sf: str) -> DataFrame:
    labelled = inputs.labelled_pairs(spark, sf)
    return sampling.quota_sample(labelled, "weak_intent", airline.QUOTAS).select("pair_id", "weak_intent")


def train_split(spark: SparkSession, sf: str) -> DataFrame:
    labelled = inputs.labelled_pairs(spark, sf).select("pair_id", "weak_intent")
    return sampling.stratified_split(labelled, "weak_intent")


def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.first_rows(inputs.pairs(spark, sf), 30, "pair_id").select("pair_id", "customer_clean")


def exclude_golden(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.language_rows(spark, sf)
    return sampling.exclude_ids(rows, inputs.language_golden(spark, sf)).select("pair_id", "weak_intent")


# --- golden set -----------------------------------------------------------------------


def _template(spark: SparkSession, sf: str) -> DataFrame:
    return golden.golden_template(inputs.labelled_pairs(spark, sf), airline.QUOTAS)


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    labels = inputs.gold_labels(spark, sf)
    return golden.merge_labels(_template(spark, sf), labels, "first_pass")


def golden_template(spark: SparkSession, sf: str) -> DataFrame:
    return _template(spark, sf).select(
        "pair_id", "weak_intent_reference_only", "gold_intent", "labeled_by"
    )


def merge_gold(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select(
        "pair_id", "gold_intent", "gold_escalate", "gold_reason", "labeled_by"
    )


def missing_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Template rows that labels of the escalated pairs alone would leave open."""
    labels = inputs.gold_labels(spark, sf).where(F.col("gold_escalate") == "escalate")
    return golden.missing_labels(_template(spark, sf), labels)


def stale_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Gold labels, of all documents, that no row of the template asks for."""
    return golden.stale_labels(inputs.language_golden(spark, sf), inputs.language_rows(spark, sf))


def review_overrides(spark: SparkSession, sf: str) -> DataFrame:
    """Two reviews of every label: the older blanks the reason, the newer fills in some fields."""
    labels = inputs.gold_labels(spark, sf).withColumn("labeled_by", F.lit("first_pass"))
    older = labels.select(
        "pair_id", F.lit("older").alias("gold_intent"), F.lit("auto").alias("gold_escalate"),
        F.lit("").alias("gold_reason"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("reviewed_at"),
    )
    strict = F.col("gold_intent") == "service_complaint"
    newer = labels.select(
        "pair_id", F.lit(None).cast("string").alias("gold_intent"),
        F.when(strict, F.lit("escalate")).otherwise(F.lit("")).alias("gold_escalate"),
        F.when(strict, F.lit("policy")).alias("gold_reason"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("reviewed_at"),
    )
    return golden.apply_reviews(labels, older.unionByName(newer))


def unlabelled_rows(spark: SparkSession, sf: str) -> DataFrame:
    labels = inputs.gold_labels(spark, sf)
    blanked = labels.withColumn(
        "gold_intent", F.when(F.col("gold_escalate") == "auto", F.col("gold_intent")).otherwise(F.lit(""))
    )
    return golden.unlabelled(blanked).select("pair_id")


def agreement_rate(spark: SparkSession, sf: str) -> DataFrame:
    merged = _merged(spark, sf)
    return metrics.agreement_rate(merged, "gold_intent", "weak_intent_reference_only").select(_r("agreement"))


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.value_counts(inputs.gold_labels(spark, sf), "gold_intent")


# --- metrics --------------------------------------------------------------------------


def intent_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Majority class and rule pack against the true language of every document."""
    docs = inputs.documents_by_language(spark, sf)
    systems = {"majority": metrics.majority_label(docs, "lang"), "rules": F.col("guess")}
    stacked = metrics.stack_systems(docs, "lang", systems)
    scores = metrics.intent_scores(stacked, "truth", "pred", "system")
    return scores.select("system", _r("accuracy"), _r("macro_f1"))


def class_report(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.class_report(inputs.documents_by_language(spark, sf), "lang", "guess")
    return report.select("label", _r("precision"), _r("recall"), _r("f1"), "support")


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.documents_by_language(spark, sf)
    return metrics.confusion_matrix(docs, "lang", "guess", list(inputs.LANGUAGES))


def stratum_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    table = metrics.stratum_accuracy(inputs.documents_by_language(spark, sf), "lang", "guess", "source")
    return table.select("source", "n", _r("accuracy"))


def _toxic(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    labels = inputs.table(spark, sf, "labels").select("doc_id", "toxic")
    flags = rule_functions.FlagSet(inputs.INSULTS).detect(F.col("text"))
    return docs.join(labels, "doc_id").select("doc_id", "toxic", (F.size(flags) > 0).cast("int").alias("flagged"))


def escalation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Always, never, and the insult flags against the toxicity labels."""
    stacked = evaluation.escalation_systems(
        _toxic(spark, sf), F.col("toxic"), F.col("flagged")
    )
    scores = metrics.binary_scores(stacked, "truth", "pred", "system")
    return scores.select("system", _r("precision"), _r("recall"), _r("f1"))


def prediction_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Row-level predictions of the rules and the decision, with their correctness."""
    labels = inputs.gold_labels(spark, sf)
    joined = inputs.labelled_pairs(spark, sf).join(labels, "pair_id").select(
        "pair_id", "gold_intent", "gold_escalate", F.col("customer_clean").alias("text"),
        F.col("weak_intent").alias("intent"), F.lit(0.9).alias("confidence"),
    )
    decided = with_decision(joined, inputs.DESK.policy).select(
        "pair_id", "gold_intent", "gold_escalate", F.col("intent").alias("pred_intent"),
        as_code(F.col("escalate")).alias("pred_escalate"),
    )
    flagged = metrics.correctness_flags(decided)
    return flagged.withColumn("pred_code", from_code(F.col("pred_escalate")).cast("long"))


# --- TF-IDF and retrieval -------------------------------------------------------------


def tfidf_vocab(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.table(spark, sf, "documents")
    return tfidf.vocabulary(docs, "text", min_df=2).select("term", "cf", "df", _r("idf"))


def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Damped weights of the pairs' customer texts, as the classifier sees them."""
    pairs = inputs.pairs(spark, sf)
    model = tfidf.TfidfModel.fit(pairs, "customer_clean", min_df=2, sublinear=True)
    weights = tfidf.term_weights(model, pairs, "pair_id", "customer_clean")
    return weights.select("pair_id", "term", _r("weight"))


def retrieve_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The three closest past cases of every inbound message, within its weak intent."""
    hits = inputs.case_index(spark, sf).top_k(inputs.rule_classified(spark, sf), 3)
    return retrieval.exploded(hits).select("id", F.col("rank").cast("long"), "pair_id", "similarity")


def retrieve_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark texts under an intent that no case has, so the whole corpus is searched."""
    items = inputs.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("id"), "text", F.lit("lost_property").alias("intent")
    )
    hits = inputs.case_index(spark, sf).top_k(items, 2)
    return retrieval.exploded(hits).select("id", F.col("rank").cast("long"), "pair_id", "similarity")


# --- drafting -------------------------------------------------------------------------


def _drafted(spark: SparkSession, sf: str) -> DataFrame:
    decided = triage_plan.decide(inputs.rule_classified(spark, sf), inputs.DESK)
    return triage_plan.draft(decided, inputs.case_index(spark, sf), inputs.DESK)


def template_reply(spark: SparkSession, sf: str) -> DataFrame:
    return _drafted(spark, sf).select("id", "draft_reply", "reply_mode")


def triage(spark: SparkSession, sf: str) -> DataFrame:
    """Rule intent to draft, for every inbound message."""
    drafted = _drafted(spark, sf)
    found = F.array_join(F.transform("hits", lambda h: h["pair_id"]), "|")
    return drafted.select(
        "id", "intent", "escalate", _joined("reasons"), found.alias("retrieved"), "draft_reply"
    )


def grounding_prompt(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of each whole prompt and of its examples block."""
    prompted = triage_plan.with_prompts(_drafted(spark, sf), inputs.DESK)
    block = drafting.examples_block(F.col("hits"))
    return prompted.select(
        "id", F.md5(block).alias("examples_md5"), F.md5("prompt").alias("prompt_md5"),
    )


def judge_prompt(spark: SparkSession, sf: str) -> DataFrame:
    drafted = _drafted(spark, sf)
    prompt = drafting.judge_prompt(F.col("text"), F.col("hits"), F.col("draft_reply"), inputs.BRAND)
    return drafted.select("id", F.md5(prompt).alias("prompt_md5"))


def external_replies(spark: SparkSession, sf: str) -> DataFrame:
    """A text model that answered some messages, failed on others and skipped the rest."""
    drafted = _drafted(spark, sf)
    n = F.col("id").cast("long") % 3
    replies = drafted.select(
        "id",
        F.when(n == 0, F.concat(F.lit(" on it: "), F.col("id"))).alias("reply"),
        F.when(n == 1, F.lit("timeout")).alias("error"),
    )
    return triage_plan.with_external_replies(drafted, replies).select("id", "draft_reply", "reply_mode")


# --- judging --------------------------------------------------------------------------


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    """A judge's raw answers for every pair: plain, fenced, broken or out of range."""
    n = F.substring("pair_id", len(inputs.PREFIX) + 2, 18).cast("long")
    body = F.format_string(
        '{"grounded": %d, "relevant": %d, "tone": %d, "actionable": %d, "notes": "case %d"}',
        n % 5 + 1, n % 4 + 2, n % 3 + 3, F.when(n % 13 == 5, 9).otherwise((n * 7) % 5 + 1), n,
    )
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    shape = n % 7
    response = F.when(shape == 3, fenced).when(shape == 5, F.lit("I would rather not")).otherwise(body)
    return inputs.pairs(spark, sf).select("pair_id", response.alias("response"))


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    drafts = inputs.pairs(spark, sf).select(
        "pair_id", "customer_clean", F.col("agent_clean").alias("draft_reply")
    )
    return judging.judged_replies(drafts, _responses(spark, sf))


def _both(spark: SparkSession, sf: str) -> DataFrame:
    n = F.substring("pair_id", len(inputs.PREFIX) + 2, 18).cast("long")
    human = inputs.pairs(spark, sf).select(
        "pair_id",
        *[((n * (i + 2)) % 5 + 1).alias(f"human_{d}") for i, d in enumerate(JUDGE_DIMENSIONS)],
    )
    return judging.with_human(_scores(spark, sf), human)


def judge_parse(spark: SparkSession, sf: str) -> DataFrame:
    scores = [F.col(d).cast("long") for d in JUDGE_DIMENSIONS]
    return _scores(spark, sf).select("pair_id", *scores, "notes", "in_range")


def judge_means(spark: SparkSession, sf: str) -> DataFrame:
    return judging.judge_means(_scores(spark, sf)).select("dimension", _r("mean_score"))


def judge_vs_human(spark: SparkSession, sf: str) -> DataFrame:
    return judging.mean_difference(_both(spark, sf)).select("dimension", "n", _r("mean_abs_diff"))


def judge_kappa(spark: SparkSession, sf: str) -> DataFrame:
    table = judging.judge_kappa(_both(spark, sf))
    return table.select("dimension", "n", _r("agreement"), _r("kappa"))


# --- model ----------------------------------------------------------------------------


def train_model(spark: SparkSession, sf: str) -> DataFrame:
    """The rows each label of the fitted language model was trained and validated on."""
    split = inputs.language_training(spark, sf)
    held = F.col("is_validation").cast("long")
    sizes = split.groupBy(F.col("weak_intent").alias("label")).agg(
        F.sum(1 - held).alias("n_train"), F.sum(held).alias("n_validation")
    )
    labels = F.array(*[F.lit(x) for x in inputs.language_model(spark, sf).labels])
    return sizes.where(F.array_contains(labels, F.col("label")) | (F.col("n_train") == 0))


def model_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The metadata record, written and read back."""
    model, split = inputs.language_model(spark, sf), inputs.language_training(spark, sf)
    path = new_path(spark, "metadata")
    sources.write_metadata(training.training_metadata(model, split, "customer_clean"), path)
    done = spark.read.json(path)
    sound = F.col("held_out_weak_val_accuracy").between(0.0, 1.0)
    return done.select("n_train", sound.alias("accuracy_in_range"))


def _scored_terms(model: training.IntentModel, scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(at, error, value) of the vectors ``features`` of scored rows, and (label, at, weight) of the model.

    Each row has one more entry, at -1 and of value 1, which stands for the offset.
    """
    spark = scored.sparkSession
    weights = model.regression.coefficientMatrix.toArray()
    table = pa.table({
        "label": pa.array([x for x in model.labels for _ in range(weights.shape[1])]),
        "at": pa.array(list(range(weights.shape[1])) * len(model.labels), pa.int32()),
        "weight": pa.array(weights.ravel()),
    })
    raw = F.unwrap_udt("features")
    ids, values = F.concat(raw["indices"], F.array(F.lit(-1))), F.concat(raw["values"], F.array(F.lit(1.0)))
    entries = scored.select("error", F.explode(F.arrays_zip(ids.alias("at"), values.alias("value"))).alias("e"))
    return entries.select("error", "e.at", "e.value"), spark.createDataFrame(table)


def model_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """Largest entry of the loss gradient of each label, over the inverse penalty and weights.

    The penalised loss is strictly convex in the coefficients, so a gradient that vanishes
    proves the fit. It is taken from the model's coefficients and vectors made once, by aggregates.
    """
    return gradient_of(inputs.language_model(spark, sf),
                       inputs.language_training(spark, sf).where(~F.col("is_validation")))


def gradient_of(model: training.IntentModel, rows: DataFrame, strength: float = 2.0) -> DataFrame:
    sizes = rows.groupBy("weak_intent").agg(F.count("*").alias("n"))
    total, labels = rows.count(), len(model.labels)
    scored = model.vectors.with_vector(rows, "customer_clean", "features").withColumn(
        "probability", model.regression.probabilities(F.col("features"))
    )
    weight = F.lit(float(total)) / (labels * F.col("n"))
    own = [F.lit(x) == F.col("weak_intent") for x in model.labels]
    errors = scored.join(F.broadcast(sizes), "weak_intent").select("features", F.array(*[
        weight * (F.get("probability", F.lit(i)) - own[i].cast("double")) for i in range(labels)
    ]).alias("error"))
    terms, weights = _scored_terms(model, errors)
    # one row a term and task leaves the tasks, whatever the number of entries and labels
    sums = terms.groupBy("at").agg(*[
        F.sum(F.col("value") * F.get("error", F.lit(i))).alias(f"_s{i}") for i in range(labels)
    ])
    per_label = F.array(*[
        F.struct(F.lit(x).alias("label"), F.col(f"_s{i}").alias("slope")) for i, x in enumerate(model.labels)
    ])
    slopes = stage(sums.select("at", F.explode(per_label).alias("e")).select("at", "e.*"), "slopes")
    entry = (F.coalesce("slope", F.lit(0.0)) + F.col("weight") / strength) / total
    sized = weights.join(slopes, ["label", "at"], "left").select("label", F.abs(entry).alias("size"))
    offsets = slopes.where("at = -1").select("label", (F.abs("slope") / total).alias("size"))
    worst = sized.unionByName(offsets).groupBy("label").agg(F.max("size").alias("size"))
    return worst.select("label", F.round("size", 3).alias("gap"))


def classify_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = inputs.model(spark, sf).classify(inputs.customer_messages(spark, sf).drop("confidence"))
    return scored.select("id", "intent", _r("confidence"))


def top_terms(spark: SparkSession, sf: str) -> DataFrame:
    table = inputs.model(spark, sf).top_terms(spark, 10)
    return table.select("label", F.col("rank").cast("long"), "term", _r("weight"))


def evaluate_intents(spark: SparkSession, sf: str) -> DataFrame:
    """Majority, rules and classifier against the true language of the held-out rows."""
    return _evaluation(spark, sf).intents.select("system", _r("accuracy"), _r("macro_f1"))


def evaluate_baselines(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the evaluation that need no classifier."""
    return evaluate_intents(spark, sf).where("system <> 'trained_classifier'")


def evaluate_escalations(spark: SparkSession, sf: str) -> DataFrame:
    result = _evaluation(spark, sf)
    return result.escalations.select("system", _r("precision"), _r("recall"), _r("f1"))


def model_report(spark: SparkSession, sf: str) -> DataFrame:
    report = _evaluation(spark, sf).report
    return report.select("label", _r("precision"), _r("recall"), _r("f1"), "support")


def model_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluation(spark, sf).matrix


def model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluation(spark, sf).predictions.select(
        "pair_id", "gold_intent", "pred_intent", _r("pred_confidence"), "pred_escalate",
        "intent_correct", "escalate_correct",
    )


def _evaluation(spark: SparkSession, sf: str) -> evaluation.Evaluation:
    gold = inputs.language_golden(spark, sf).drop("weak_intent")
    classified = inputs.language_model(spark, sf).classify(gold, "customer_clean")
    rules = inputs.LANGUAGE_RULES.label(F.col("customer_clean"))
    return evaluation.evaluate(classified, rules, inputs.LANGUAGE_POLICY)


def triage_model(spark: SparkSession, sf: str) -> DataFrame:
    """Classifier intent to draft, for every inbound message."""
    asked = inputs.customer_messages(spark, sf).drop("confidence")
    drafted = triage_plan.triage(asked, inputs.model(spark, sf), inputs.case_index(spark, sf), inputs.DESK)
    return drafted.select("id", "intent", _r("confidence"), "escalate", _joined("reasons"), "draft_reply")


# --- streams --------------------------------------------------------------------------


def _message_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Inbound messages as a stream in which every message arrives twice."""
    schema = inputs.table(spark, sf, "conversations").schema
    # a pattern and not a path: the table may be one file, which a stream does not take as its folder
    turns = spark.readStream.schema(schema).parquet(f"{sf}/conversations.parque[t]")
    raw = inputs.raw_rows(turns).where(F.col("inbound") == "True")
    sent = F.timestamp_seconds(F.lit(1483430400) + F.col("ordinal") % 600)
    once = raw.select(
        F.col("message_id").alias("id"), text.clean_text(F.col("text")).alias("text"),
        sent.alias("sent_at"), (((F.col("ordinal") * 13) % 200).cast("double") / 200).alias("confidence"),
    )
    return once.unionByName(once)


def stream_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Rule label and decision of a message stream, repeats removed."""
    unique = live.unique_messages(_message_stream(spark, sf))
    decided = triage_plan.decide(unique.withColumn("intent", inputs.RULES.label(F.col("text"))), inputs.DESK)
    path = new_path(spark, "stream-decisions")
    query = (
        decided.select("id", "intent", "confidence", "escalate", _joined("reasons"))
        .writeStream.format("parquet").option("path", f"{path}/rows")
        .option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def stream_triage(spark: SparkSession, sf: str) -> DataFrame:
    """The whole triage on a stream: classifier, decision, retrieval and draft."""
    path = new_path(spark, "stream-triage")
    stream = _message_stream(spark, sf).drop("confidence")
    decided = live.classified_stream(stream, inputs.model(spark, sf), inputs.DESK)
    query = live.start_triage(
        decided, inputs.case_index(spark, sf), inputs.DESK, f"{path}/rows", f"{path}/progress",
        available_now=True,
    )
    query.awaitTermination()
    done = spark.read.parquet(f"{path}/rows")
    return done.select("id", "intent", _r("confidence"), "escalate", _joined("reasons"), "draft_reply")


QUERIES = {
    f.__name__: f
    for f in (
        clean_text, html_decode, message_time, blank_guard, ngrams,
        csv_scan, monthly_sink, row_counts,
        reply_join, first_turns, pair_ids, first_copies,
        weak_label, language_label, rule_matches, label_distribution, label_display, red_flags,
        escalation_decision, decision_counts,
        month_sample, quota_sample, train_split, first_rows, exclude_golden,
        golden_template, merge_gold, missing_labels, stale_labels, review_overrides,
        unlabelled_rows, agreement_rate, value_counts,
        intent_metrics, class_report, confusion_matrix, stratum_accuracy, escalation_metrics,
        prediction_flags,
        tfidf_vocab, tfidf_weights, retrieve_topk, retrieve_fallback,
        template_reply, triage, grounding_prompt, judge_prompt, external_replies,
        judge_parse, judge_means, judge_vs_human, judge_kappa,
        train_model, model_metadata, model_gradient,
        classify_scores, top_terms, evaluate_intents, evaluate_baselines, evaluate_escalations,
        model_report, model_matrix, model_predictions,
        triage_model, stream_decisions, stream_triage,
    )
}
