"""The same results in plain SQL, for DuckDB over the same tables.

RE2 knows only ASCII word boundaries. The rule patterns are ASCII, so other letters are
mapped to one ASCII letter and other symbols to a control character before matching.
"""

from __future__ import annotations

from replylane.functions.rules import RuleSet
from replylane.packs import airline
from replylane.registry import inputs

W = "[\\p{L}\\p{N}_]"
DIMENSIONS = ("grounded", "relevant", "tone", "actionable")


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _decode(x: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&quot;", '"'),
                       ("&copy;", "©"), ("&middot;", "·")):
        x = f"replace({x}, {_q(name)}, {_q(char)})"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _clean(x: str) -> str:
    space = "[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]"
    not_space = space.replace("[", "[^", 1)
    x = _decode(f"coalesce({x}, '')")
    x = f"regexp_replace({x}, 'https?://{not_space}+', '', 'g')"
    x = f"regexp_replace({x}, '@{W}+', '', 'g')"
    return f"trim(regexp_replace({x}, '{space}+', ' ', 'g'))"


def _ascii(x: str) -> str:
    symbols = f"regexp_replace(lower({x}), '[^\\x00-\\x7F\\p{{L}}\\p{{N}}]', chr(1), 'g')"
    return f"regexp_replace({symbols}, '[^\\x00-\\x7F]', 'Z', 'g')"


def _hit(x: str, patterns) -> str:
    return f"regexp_matches({x}, {_q('|'.join(f'(?:{p})' for p in patterns))})"


def _label(x: str, rules: RuleSet, value=lambda i, label: _q(label), default=None) -> str:
    whens = " ".join(
        f"WHEN {_hit(x, patterns)} THEN {value(i, label)}"
        for i, (label, patterns) in enumerate(rules.rules)
    )
    return f"CASE {whens} ELSE {_q(rules.default) if default is None else default} END"


def _flags(x: str) -> str:
    tests = ", ".join(f"CASE WHEN {_hit(x, [p])} THEN {_q(n)} END" for n, p in airline.FLAGS)
    return f"list_filter([{tests}], lambda f: f IS NOT NULL)"


N = len(inputs.PHRASES)

RAW = f"""raw AS (
  SELECT CAST(k AS VARCHAR) AS message_id,
    CASE WHEN role = 'assistant' THEN '{inputs.BRAND}' ELSE role || '-' || conv_id END AS author_id,
    role = 'user' AS inbound,
    CASE WHEN conv_id % 41 = 7 THEN 'some day in spring'
         ELSE strftime(sent, '%a %b %d %H:%M:%S +0000 %Y') END AS created_at,
    CASE WHEN conv_id % 41 <> 7 THEN sent END AS sent_at,
    CASE WHEN role <> 'user' THEN text
         ELSE '@{inputs.BRAND} ' || CASE WHEN turn % 3 = 0 THEN phrase || ' ' || text
              ELSE text || ' ' || phrase END || ' https://acme.example/t/' || conv_id END AS text,
    CASE WHEN turn > 0 THEN CAST(k - 1 AS VARCHAR) END AS reply_to_id,
    k AS ordinal
  FROM (SELECT *, conv_id * 1000 + turn AS k,
      ({_list(inputs.PHRASES)})[1 + (conv_id * 7 + turn) % {N}] AS phrase,
      epoch_ms(1000 * (1483430400 + ((conv_id * 37) % 240) * 86400 + (conv_id % 1440) * 60
        + turn * 61)) AS sent
    FROM conversations))"""

ASKED = f"""{RAW}, asked AS (
  SELECT *, {_ascii('text')} AS t FROM (
    SELECT message_id AS id, {_clean('text')} AS text,
      CAST((ordinal * 13) % 200 AS DOUBLE) / 200 AS confidence
    FROM raw WHERE inbound))"""

CLASSIFIED = f"""{ASKED}, classified AS (
  SELECT *, {_label('t', inputs.RULES)} AS intent FROM asked)"""

# Decision from columns t (matching text), intent and confidence.
DECIDED = f"""flagged AS (SELECT *, {_flags('t')} AS flags FROM to_decide),
found AS (SELECT *, flags
    || CASE WHEN intent IN ('service_complaint', 'refund_compensation_request')
              AND len(flags) = 0 THEN ['intent_default_escalate:' || intent] ELSE [] END
    || CASE WHEN confidence < 0.45
            THEN ['low_classifier_confidence:' || printf('%.2f', confidence)] ELSE [] END AS r
  FROM flagged),
decided AS (SELECT *, len(r) > 0 AS escalate, array_to_string(CASE WHEN len(r) > 0 THEN r
    WHEN intent = 'praise_thanks' THEN ['low_risk_intent:praise_thanks']
    ELSE ['no_red_flags_routine_intent'] END, '|') AS reasons FROM found)"""

DECISIONS = f"{CLASSIFIED}, to_decide AS (SELECT * FROM classified), {DECIDED}"

JOINED = f"""{RAW}, replies AS (
  SELECT c.message_id AS customer_message_id, a.message_id AS agent_message_id,
    {_clean('c.text')} AS customer_clean, {_clean('a.text')} AS agent_clean,
    c.sent_at AS customer_time, a.created_at AS agent_time,
    c.reply_to_id AS above, a.sent_at AS replied_at, a.created_at
  FROM raw a JOIN raw c ON a.reply_to_id = c.message_id
  WHERE a.author_id = '{inputs.BRAND}' AND c.inbound)"""

PAIRS = f"""{JOINED}, pairs AS (
  SELECT *, printf('{inputs.PREFIX}-%06d', n) AS pair_id
  FROM (SELECT *, row_number() OVER (
      ORDER BY customer_time NULLS LAST, customer_message_id, agent_message_id) - 1 AS n
    FROM replies WHERE length(customer_clean) >= 8))"""

LABELLED = f"""{PAIRS}, labelled AS (
  SELECT *, {_label(_ascii('customer_clean'), inputs.RULES)} AS weak_intent FROM pairs)"""

GOLD = f"""{LABELLED}, gold AS (
  SELECT pair_id, CASE WHEN n % 5 = 0 THEN ({_list(airline.INTENTS)})[1 + n % {len(airline.INTENTS)}]
      ELSE weak_intent END AS gold_intent,
    CASE WHEN n % 3 = 0 THEN 'escalate' ELSE 'auto' END AS gold_escalate,
    'case ' || (n % 7) AS gold_reason
  FROM labelled)"""


def _quota(quotas: dict[str, int]) -> str:
    rows = ", ".join(f"({_q(k)}, {v})" for k, v in quotas.items())
    return f"""quotas(weak_intent, k) AS (VALUES {rows}), template AS (
  SELECT l.* FROM (SELECT *, row_number() OVER (
      PARTITION BY weak_intent ORDER BY md5('42:' || pair_id), pair_id) AS place
    FROM labelled) l JOIN quotas q USING (weak_intent) WHERE place <= k)"""


TEMPLATE = f"{GOLD}, {_quota(airline.QUOTAS)}"

SCORES = f"""{PAIRS}, answers AS (
  SELECT pair_id, n, n % 7 <> 5 AS readable FROM pairs),
scores AS (
  SELECT pair_id, n, CASE WHEN readable THEN n % 5 + 1 END AS grounded,
    CASE WHEN readable THEN n % 4 + 2 END AS relevant,
    CASE WHEN readable THEN n % 3 + 3 END AS tone,
    CASE WHEN readable THEN CASE WHEN n % 13 = 5 THEN 9 ELSE (n * 7) % 5 + 1 END END AS actionable,
    CASE WHEN readable THEN 'case ' || n ELSE 'error: unreadable judge answer' END AS notes,
    readable AND n % 13 <> 5 AS in_range
  FROM answers)"""

BOTH = SCORES + ", both_sides AS (" + " UNION ALL ".join(
    f"SELECT {_q(d)} AS dimension, {d} AS m, (n * {i + 2}) % 5 + 1 AS h FROM scores"
    for i, d in enumerate(DIMENSIONS)
) + ")"

GUESSED = f"""guessed AS (
  SELECT doc_id, lang, source, {_label(_ascii('text'), inputs.LANGUAGE_RULES)} AS guess
  FROM documents)"""

LANGUAGE_GOLDEN = f"""{GUESSED}, labelled AS (
  SELECT CAST(g.doc_id AS VARCHAR) AS pair_id, g.doc_id, g.lang, d.text, guess AS weak_intent
  FROM guessed g JOIN documents d USING (doc_id)), {_quota(inputs.LANGUAGE_QUOTAS)}"""

LANGUAGE_KEPT = f"""whole AS (WITH {LANGUAGE_GOLDEN}
  SELECT pair_id, weak_intent FROM labelled WHERE pair_id NOT IN (SELECT pair_id FROM template)),
labelled AS (SELECT * FROM whole)"""

PER_LABEL = """labels_seen AS (SELECT truth AS label FROM p UNION SELECT pred FROM p),
per_label AS (
  SELECT label, hits, support, predicted,
    CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
    2.0::DOUBLE * hits / (support + predicted) AS f1
  FROM (SELECT label, (SELECT count(*) FROM p WHERE truth = label AND pred = label) AS hits,
      (SELECT count(*) FROM p WHERE truth = label) AS support,
      (SELECT count(*) FROM p WHERE pred = label) AS predicted FROM labels_seen))"""


def _terms(source: str, key: str, column: str) -> str:
    """CTE ``terms(key, term)``: every n-gram occurrence of the source table."""
    return f"""tokens AS (SELECT {key} AS key,
    regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM {source}),
grams AS (SELECT key, w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g
  FROM tokens),
terms AS (SELECT key, unnest(g) AS term FROM grams),
counts AS (SELECT key, term, count(*) AS c FROM terms GROUP BY ALL)"""


def _vocab(source: str, min_df: int) -> str:
    return f"""vocab AS (
  SELECT term, cf, df, ln((1.0::DOUBLE + (SELECT count(*) FROM {source})) / (1.0::DOUBLE + df)) + 1 AS idf
  FROM (SELECT term, CAST(sum(c) AS BIGINT) AS cf, count(*) AS df FROM counts GROUP BY term)
  WHERE df >= {min_df} ORDER BY cf DESC, term LIMIT 20000)"""


def _retrieval(queries: str, k: int) -> str:
    """Full scoring of ``queries(id, text, bucket)``; a null bucket searches everything."""
    return f"""corpus AS (SELECT * FROM labelled WHERE length(agent_clean) >= 25),
{_terms('corpus', 'pair_id', 'customer_clean')}, {_vocab('corpus', 1)},
doc_w AS (SELECT key, term, c * idf AS w FROM counts JOIN vocab USING (term)),
doc_v AS (SELECT key, term, w / sqrt(sum(w * w) OVER (PARTITION BY key)) AS w FROM doc_w),
asked_q AS ({queries}),
q_tokens AS (SELECT id, bucket,
    regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM asked_q),
q_terms AS (SELECT id, unnest(w || list_transform(range(1, len(w)),
    lambda i: w[i] || ' ' || w[i + 1])) AS term FROM q_tokens),
q_w AS (SELECT id, term, count(*) * any_value(idf) AS w FROM q_terms JOIN vocab USING (term) GROUP BY ALL),
q_v AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM q_w),
dots AS (SELECT q.id, d.key, round(sum(q.w * d.w), 6) AS s FROM q_v q JOIN doc_v d USING (term)
  GROUP BY q.id, d.key),
ranked AS (SELECT a.id, c.pair_id, c.agent_clean, c.customer_clean, coalesce(s, 0) AS similarity,
    row_number() OVER (PARTITION BY a.id ORDER BY coalesce(s, 0) DESC, c.pair_id) AS rank
  FROM asked_q a JOIN corpus c ON a.bucket IS NULL OR a.bucket = c.weak_intent
  LEFT JOIN dots ON dots.id = a.id AND dots.key = c.pair_id
  QUALIFY rank <= {k})"""


HITS = f"""{LABELLED}, {CLASSIFIED.split(RAW + ', ')[1]}, {_retrieval(
    "SELECT id, text, CASE WHEN intent IN (SELECT weak_intent FROM labelled "
    "WHERE length(agent_clean) >= 25) THEN intent END AS bucket FROM classified", 3)}"""

_templates = " ".join(
    f"WHEN {_q(k)} THEN {_q(v)}" for k, v in inputs.DESK.templates.items()
)
DRAFTED = f"""{HITS}, to_decide AS (SELECT * FROM classified), {DECIDED},
hit_lists AS (SELECT id, array_to_string(list(pair_id ORDER BY rank), '|') AS retrieved,
    array_to_string(list('- Customer: ' || customer_clean || chr(10) || '  Agent replied: '
      || agent_clean ORDER BY rank), chr(10)) AS block,
    min(agent_clean) FILTER (WHERE rank = 1) AS top
  FROM ranked GROUP BY id),
drafted AS (SELECT d.*, retrieved, block,
    replace(replace(CASE intent {_templates} END, '{{name}}', 'there'), '{{retrieved_hint}}',
      '(Similar past case was resolved: "' || substring(top, 1, 120) || '")') AS draft_reply
  FROM decided d JOIN hit_lists USING (id))"""


def _with(ctes: str, select: str) -> str:
    """A statement over these tables; a select that begins with a comma adds its own."""
    return f"WITH {ctes}{select}" if select.startswith(",") else f"WITH {ctes}\n{select}"


def statements() -> dict[str, str]:
    month = "strftime(customer_time, '%Y-%m')"
    seconds = "strftime(customer_time, '%Y-%m-%d %H:%M:%S')"
    out = {
        "clean_text": f"SELECT doc_id, {_clean('text')} AS clean FROM documents",
        "html_decode": f"SELECT page_id, {_decode('html')} AS decoded FROM pages",
        "message_time": _with(RAW, "SELECT message_id, strftime(sent_at, '%Y-%m-%d %H:%M:%S') "
                              "AS sent_at, strftime(sent_at, '%Y-%m') AS month FROM raw"),
        "blank_guard": _with(RAW, f"SELECT message_id, length({_clean('text')}) AS size FROM raw "
                             f"WHERE {_clean('text')} <> ''"),
        "ngrams": _with(_terms("documents", "doc_id", "text"),
                        "SELECT key AS doc_id, CAST(len(g) AS BIGINT) AS n_terms, "
                        "md5(array_to_string(g, '|')) AS terms_md5 FROM grams"),
        "csv_scan": _with(RAW, "SELECT message_id, author_id, inbound, created_at, text, "
                          "reply_to_id FROM raw"),
        "monthly_sink": _with(PAIRS, f"SELECT coalesce({month}, 'none') AS month, count(*) AS n "
                              "FROM pairs GROUP BY 1"),
        "row_counts": _with(PAIRS, "SELECT (SELECT count(*) FROM raw) AS messages, (SELECT count(*) "
                            f"FROM raw WHERE author_id = '{inputs.BRAND}') AS replies, "
                            "(SELECT count(*) FROM pairs) AS pairs"),
        "reply_join": _with(JOINED, "SELECT customer_message_id, agent_message_id, customer_clean, "
                            "agent_clean FROM replies WHERE length(customer_clean) >= 8"),
        "first_turns": _with(JOINED, "SELECT customer_message_id, agent_message_id FROM replies "
                             "WHERE above IS NULL QUALIFY row_number() OVER (PARTITION BY "
                             "customer_message_id ORDER BY replied_at NULLS LAST, agent_message_id) = 1"),
        "pair_ids": _with(PAIRS, "SELECT pair_id, customer_message_id, agent_message_id, "
                          f"{seconds} AS customer_time, agent_time FROM pairs"),
        "first_copies": "SELECT doc_id, source, md5(text) AS text_md5 FROM documents "
                        "QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
        "weak_label": _with(ASKED, f"SELECT id, {_label('t', inputs.RULES)} AS weak_intent, "
                            f"{_label('t', inputs.RULES, lambda i, _: str(i + 1), 'NULL')}::BIGINT "
                            "AS matched_rule FROM asked"),
        "language_label": _with(GUESSED, "SELECT doc_id, guess FROM guessed"),
        "rule_matches": _with(CLASSIFIED, _rule_matches()),
        "label_distribution": _with(CLASSIFIED, _distribution("round(n / total, 6) AS share")),
        "label_display": _with(CLASSIFIED, "SELECT list_aggregate(list_transform("
                               "string_split(intent, '_'), lambda x: upper(x[1]) || x[2:]), "
                               "'string_agg', ' ') AS title, CAST(CAST(round_even("
                               "100.0::DOUBLE * share, 0) AS BIGINT) AS VARCHAR) || '%' AS percent FROM ("
                               + _distribution("n::DOUBLE / total AS share") + ")"),
        "red_flags": _with(ASKED, f"SELECT id, array_to_string({_flags('t')}, '|') AS flags FROM asked"),
        "escalation_decision": _with(DECISIONS, "SELECT id, intent, confidence, escalate, reasons "
                                     "FROM decided"),
        "decision_counts": _with(DECISIONS, "SELECT intent, escalate, count(*) AS n FROM decided "
                                 "GROUP BY ALL"),
        "month_sample": _with(PAIRS, f"""SELECT pair_id, {seconds} AS customer_time FROM (
  SELECT *, row_number() OVER (PARTITION BY {month} ORDER BY md5('42:' || pair_id), pair_id) AS place,
    count(*) OVER (PARTITION BY {month}) AS size, count(*) OVER () AS total
  FROM pairs WHERE customer_time IS NOT NULL)
WHERE place <= round_even(100.0::DOUBLE / total * size, 0)"""),
        "quota_sample": _with(f"{LABELLED}, {_quota(airline.QUOTAS)}",
                              "SELECT pair_id, weak_intent FROM template"),
        "train_split": _with(LABELLED, _split()),
        "first_rows": _with(PAIRS, "SELECT pair_id, customer_clean FROM pairs ORDER BY pair_id LIMIT 30"),
        "exclude_golden": _with(LANGUAGE_GOLDEN,
                                "SELECT pair_id, weak_intent FROM labelled WHERE NOT EXISTS ("
                                "SELECT 1 FROM template t WHERE t.pair_id = labelled.pair_id)"),
        "golden_template": _with(f"{LABELLED}, {_quota(airline.QUOTAS)}",
                                 "SELECT pair_id, weak_intent AS weak_intent_reference_only, "
                                 "'' AS gold_intent, '' AS labeled_by FROM template"),
        "merge_gold": _with(TEMPLATE, "SELECT pair_id, gold_intent, gold_escalate, gold_reason, "
                            "'first_pass' AS labeled_by FROM template JOIN gold USING (pair_id)"),
        "missing_labels": _with(TEMPLATE, "SELECT pair_id FROM template JOIN gold USING (pair_id) "
                                "WHERE gold_escalate <> 'escalate'"),
        "stale_labels": _with(LANGUAGE_GOLDEN, "SELECT pair_id FROM labelled WHERE pair_id NOT IN "
                              "(SELECT pair_id FROM template)"),
        "train_model": f"""WITH split AS (WITH {LANGUAGE_KEPT}
{_split()})
SELECT weak_intent AS label, CAST(count(*) FILTER (WHERE NOT is_validation) AS BIGINT) AS n_train,
  CAST(count(*) FILTER (WHERE is_validation) AS BIGINT) AS n_validation
FROM split GROUP BY 1""",
        "model_metadata": f"""WITH {LANGUAGE_KEPT}
SELECT CAST(count(*) - ceil(0.1::DOUBLE * count(*)) AS BIGINT) AS n_train, true AS accuracy_in_range
FROM labelled""",
        "model_round_trip": "SELECT CAST(doc_id AS VARCHAR) AS pair_id, CAST(0 AS BIGINT) AS differs FROM documents",
        "score_agreement": "SELECT CAST(doc_id AS VARCHAR) AS pair_id, 0.0::DOUBLE AS gap FROM documents",
        "classify_certificate": _with(ASKED, "SELECT id, 0.0::DOUBLE AS gap FROM asked"),
        "accuracy_certificate": f"""WITH {LANGUAGE_KEPT}
SELECT CAST(count(*) - ceil(0.1::DOUBLE * count(*)) AS BIGINT) AS n_train, 0.0::DOUBLE AS gap
FROM labelled""",
        "top_terms_certificate": f"""WITH split AS (WITH {LANGUAGE_KEPT}
{_split()})
SELECT DISTINCT weak_intent AS label, CAST(10 AS BIGINT) AS n_terms, CAST(0 AS BIGINT) AS wrong
FROM split WHERE NOT is_validation""",
        "evaluation_certificate": "SELECT unnest(['accuracy', 'macro_f1', 'report']) AS metric, 0.0::DOUBLE AS gap",
        "stream_certificate": _with(ASKED, "SELECT id, CAST(0 AS BIGINT) AS differs FROM asked WHERE text <> ''"),
        "index_round_trip": _with(ASKED, "SELECT id, CAST(0 AS BIGINT) AS differs FROM asked"),
        "rule_table": """WITH w AS (
  SELECT DISTINCT unnest(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z]+')) AS word FROM benchmark
), r AS (
  SELECT length(word) AS priority, word[1:3] AS label, '(^|[^a-z])' || word || '(s|ed)?([^a-z]|$)' AS pattern, word
  FROM w WHERE length(word) >= 8
), d AS (SELECT doc_id, lower(text) AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, count(*) AS hits, CAST(min(priority) AS BIGINT) AS priority, min(label) AS label
FROM d JOIN r ON contains(t, word) AND regexp_matches(t, pattern) GROUP BY doc_id""",
        "model_gradient": f"""WITH split AS (WITH {LANGUAGE_KEPT}
{_split()})
SELECT DISTINCT weak_intent AS label, 0.0::DOUBLE AS gap FROM split WHERE NOT is_validation""",
        "evaluate_baselines": " UNION ALL ".join(
            f"SELECT * FROM (WITH {LANGUAGE_GOLDEN}, p AS (SELECT lang AS truth, {pred} AS pred FROM template), "
            f"{PER_LABEL} SELECT {_q(name)} AS system, (SELECT round(avg((truth = pred)::INT), 6) FROM p) "
            "AS accuracy, (SELECT round(avg(f1), 6) FROM per_label) AS macro_f1)"
            for name, pred in (
                ("trivial_majority_class",
                 "(SELECT lang FROM template GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"),
                ("simple_rule_baseline", "weak_intent"))
        ),
        "evaluate_escalations": _escalation_metrics(
            LANGUAGE_GOLDEN + ", ", "(SELECT t.text, coalesce(l.toxic, 0) AS toxic FROM template t LEFT JOIN "
            "(SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) l USING (doc_id))"),
        "review_overrides": _with(GOLD, "SELECT pair_id, gold_intent, CASE WHEN gold_intent = "
                                  "'service_complaint' THEN 'escalate' ELSE gold_escalate END AS gold_escalate, "
                                  "CASE WHEN gold_intent = 'service_complaint' THEN 'policy' ELSE gold_reason END "
                                  "AS gold_reason, 'human_review' AS labeled_by FROM gold"),
        "unlabelled_rows": _with(GOLD, "SELECT pair_id FROM gold WHERE gold_escalate = 'escalate'"),
        "agreement_rate": _with(TEMPLATE, "SELECT round(avg((gold_intent = weak_intent)::INT), 6) AS "
                                "agreement FROM template JOIN gold USING (pair_id)"),
        "value_counts": _with(GOLD, "SELECT gold_intent, count(*) AS n FROM gold GROUP BY 1"),
        "intent_metrics": " UNION ALL ".join(
            f"SELECT * FROM (WITH {GUESSED}, p AS (SELECT lang AS truth, {pred} AS pred FROM guessed), "
            f"{PER_LABEL} SELECT {_q(name)} AS system, (SELECT round(avg((truth = pred)::INT), 6) FROM p) "
            "AS accuracy, (SELECT round(avg(f1), 6) FROM per_label) AS macro_f1)"
            for name, pred in (("majority", "(SELECT lang FROM guessed GROUP BY 1 ORDER BY count(*) "
                                "DESC, 1 LIMIT 1)"), ("rules", "guess"))
        ),
        "class_report": _with(f"{GUESSED}, p AS (SELECT lang AS truth, guess AS pred FROM guessed), "
                              f"{PER_LABEL}", _report()),
        "confusion_matrix": _with(GUESSED, "SELECT truth, " + ", ".join(
            f"CAST(count(*) FILTER (WHERE guess = {_q(x)}) AS BIGINT) AS {x}" for x in inputs.LANGUAGES)
            + f" FROM (SELECT unnest({_list(inputs.LANGUAGES)}) AS truth) LEFT JOIN guessed "
            "ON lang = truth GROUP BY truth"),
        "stratum_accuracy": _with(GUESSED, "SELECT source, count(*) AS n, "
                                  "round(avg((lang = guess)::INT), 6) AS accuracy FROM guessed GROUP BY 1"),
        "escalation_metrics": _escalation_metrics(),
        "prediction_flags": _with(f"{GOLD}, to_decide AS (SELECT *, {_ascii('customer_clean')} AS t, "
                                  "weak_intent AS intent, 0.9 AS confidence FROM labelled JOIN gold "
                                  f"USING (pair_id)), {DECIDED}",
                                  "SELECT pair_id, gold_intent, gold_escalate, intent AS pred_intent, "
                                  "CASE WHEN escalate THEN 'escalate' ELSE 'auto' END AS pred_escalate, "
                                  "gold_intent = intent AS intent_correct, "
                                  "(gold_escalate = 'escalate') = escalate AS escalate_correct, "
                                  "escalate::BIGINT AS pred_code FROM decided"),
        "tfidf_vocab": _with(f"{_terms('documents', 'doc_id', 'text')}, {_vocab('documents', 2)}",
                             "SELECT term, cf, df, round(idf, 6) AS idf FROM vocab"),
        "tfidf_weights": _with(
            f"{PAIRS}, {_terms('pairs', 'pair_id', 'customer_clean')}, {_vocab('pairs', 2)}, "
            "damped AS (SELECT key, term, (1 + ln(c)) * idf AS w FROM counts JOIN vocab USING (term))",
            "SELECT key AS pair_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY key)), 6) "
            "AS weight FROM damped"),
        "retrieve_topk": _with(HITS, "SELECT id, rank, pair_id, similarity FROM ranked"),
        "retrieve_fallback": _with(
            f"{LABELLED}, {_retrieval('SELECT item_id AS id, text, NULL AS bucket FROM benchmark', 2)}",
            "SELECT id, rank, pair_id, similarity FROM ranked"),
        "template_reply": _with(DRAFTED, "SELECT id, draft_reply, 'template' AS reply_mode FROM drafted"),
        "triage": _with(DRAFTED, "SELECT id, intent, escalate, reasons, retrieved, draft_reply FROM drafted"),
        "grounding_prompt": _with(DRAFTED, "SELECT id, md5(block) AS examples_md5, md5(concat(" + ", ".join((
            _q(f"Answer this customer for the {inputs.BRAND} support desk.\nIntent: "), "intent",
            _q('\nMessage: "'), "text",
            _q('"\n\nResolved cases to ground the answer in; match their tone and state no fact that '
               "neither they nor the message holds:\n"), "block",
            _q("\n\nReturn the reply text alone, at most 280 characters, brief and kind."),
        )) + ")) AS prompt_md5 FROM drafted"),
        "judge_prompt": _with(DRAFTED, f"SELECT id, {_judge_prompt()} AS prompt_md5 FROM drafted"),
        "judge_replies": _with(DRAFTED, f""", p AS (SELECT id, {_judge_prompt()} AS k FROM drafted),
d AS (SELECT id, list_transform(range(1, 5), lambda i: CAST(('0x' || k[i]) AS BIGINT)) AS d FROM p),
m AS (SELECT id, unnest([{{'dimension': 'grounded', 'm': 1 + d[1] / 4}}, {{'dimension': 'relevant', 'm': d[2] % 5 + 1}},
  {{'dimension': 'tone', 'm': d[3] % 5 + 1}}, {{'dimension': 'actionable', 'm': d[4] % 5 + 1}}], recursive := true) FROM d),
h AS (SELECT doc_id, 5 - 4 * max(toxic) AS kind, 1 + 4 * max(quality) AS good FROM labels GROUP BY 1)
SELECT dimension, round(avg(m), 6) AS mean_score, count(kind) AS n_human,
  round(avg(abs(m - CASE WHEN dimension = 'tone' THEN kind ELSE good END)), 6) AS mean_abs_diff
FROM m LEFT JOIN h ON doc_id = CAST(id AS BIGINT) // 1000 GROUP BY 1"""),
        "external_replies": _with(DRAFTED, "SELECT id, CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN "
                                  "'on it: ' || id ELSE draft_reply END AS draft_reply, "
                                  "CASE CAST(id AS BIGINT) % 3 WHEN 0 THEN 'llm' WHEN 1 THEN "
                                  "'template_fallback (llm_error: timeout)' ELSE 'template' END "
                                  "AS reply_mode FROM drafted"),
        "judge_parse": _with(SCORES, "SELECT pair_id, grounded, relevant, tone, actionable, notes, "
                             "in_range FROM scores"),
        "judge_means": _with(BOTH, "SELECT dimension, round(avg(m), 6) AS mean_score FROM both_sides GROUP BY 1"),
        "judge_vs_human": _with(BOTH, "SELECT dimension, count(*) AS n, round(avg(abs(m - h)), 6) "
                                "AS mean_abs_diff FROM both_sides GROUP BY 1"),
        "judge_kappa": _with(BOTH, """SELECT dimension, n, round(po, 6) AS agreement,
  round((po - pe) / (1 - pe), 6) + 0.0 AS kappa
FROM (SELECT dimension, count(*) AS n, avg((m = h)::INT) AS po FROM both_sides WHERE m IS NOT NULL GROUP BY 1)
JOIN (SELECT a.dimension, sum(a.s * b.s) AS pe
  FROM (SELECT dimension, m, count(*) / sum(count(*)) OVER (PARTITION BY dimension) AS s
    FROM both_sides WHERE m IS NOT NULL GROUP BY dimension, m) a
  JOIN (SELECT dimension, h, count(*) / sum(count(*)) OVER (PARTITION BY dimension) AS s
    FROM both_sides WHERE m IS NOT NULL GROUP BY dimension, h) b
  ON a.dimension = b.dimension AND a.m = b.h GROUP BY 1) USING (dimension)"""),
    }
    out["stream_decisions"] = out["escalation_decision"]
    return out


def _judge_prompt() -> str:
    """The digest of a draft's judge prompt."""
    return "md5(concat(" + ", ".join((
            _q(f'Grade a draft reply of the {inputs.BRAND} support desk.\nMessage: "'), "text",
            _q('"\nCases it was grounded in:\n'), "coalesce(nullif(block, ''), '(none retrieved)')",
            _q('\nDraft: "'), "draft_reply",
            _q('"\nGive whole scores from 1 (poor) to 5 (excellent):\n'
               "- grounded: invents no facts beyond the message and the cases\n"
               "- relevant: speaks to what the customer asked\n"
               "- tone: professional and empathetic\n"
               "- actionable: names a clear and correct next step\n"
               'Answer with one JSON object: {"grounded": n, "relevant": n, "tone": n, '
               '"actionable": n, "notes": "one sentence"}'),
    )) + "))"


def _rule_matches() -> str:
    hits = " + ".join(
        f"{_hit('t', [p])}::BIGINT" for _, patterns in inputs.RULES.rules for p in patterns
    )
    return f"SELECT id, intent AS label, {hits} AS hits FROM classified WHERE {hits} > 0"


def _distribution(share: str) -> str:
    rows = ", ".join(f"({i}, {_q(x)})" for i, x in enumerate(airline.INTENTS))
    return f"""SELECT CAST(position AS BIGINT) AS position, intent, n, {share}
FROM (SELECT position, l.intent, count(id) AS n, (SELECT count(*) FROM classified) AS total
  FROM (VALUES {rows}) l(position, intent) LEFT JOIN classified c ON c.intent = l.intent
  GROUP BY ALL)"""


def _split() -> str:
    return """SELECT pair_id, l.weak_intent, row_number() OVER (
    PARTITION BY l.weak_intent ORDER BY md5('42:' || pair_id), pair_id) <= size - given AS is_validation
FROM labelled l JOIN (
  SELECT weak_intent, size,
    whole + CASE WHEN nth <= n_train - sum(whole) OVER () THEN 1 ELSE 0 END AS given
  FROM (SELECT *, (size * n_train) // n AS whole,
      row_number() OVER (ORDER BY (size * n_train) % n DESC, weak_intent) AS nth
    FROM (SELECT weak_intent, count(*) AS size, CAST((SELECT count(*) FROM labelled) AS BIGINT) AS n,
        CAST((SELECT count(*) - ceil(0.1::DOUBLE * count(*)) FROM labelled) AS BIGINT) AS n_train
      FROM labelled GROUP BY 1))) sized ON sized.weak_intent = l.weak_intent"""


def _report() -> str:
    return """SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, support FROM per_label
UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT round(avg((truth = pred)::INT), 6) AS a,
  count(*) AS n FROM p)
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM per_label
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM per_label"""


def _escalation_metrics(
    ctes: str = "", source: str = "documents JOIN labels USING (doc_id)"
) -> str:
    flagged = _hit(_ascii("text"), [p for _, p in inputs.INSULTS])
    parts = " UNION ALL ".join(
        f"SELECT {_q(name)} AS system, toxic, {pred} AS pred FROM d"
        for name, pred in (("trivial_always_escalate", "1"), ("trivial_never_escalate", "0"),
                           ("rule_engine", "flagged"))
    )
    return f"""WITH {ctes}d AS (SELECT toxic, {flagged}::INT AS flagged FROM {source}),
s AS ({parts}), c AS (SELECT system, sum(toxic * pred)::DOUBLE AS hit, sum(pred)::DOUBLE AS claimed,
  sum(toxic)::DOUBLE AS positives FROM s GROUP BY 1)
SELECT system, CASE WHEN claimed = 0 THEN 0 ELSE round(hit / claimed, 6) END AS precision,
  CASE WHEN positives = 0 THEN 0 ELSE round(hit / positives, 6) END AS recall,
  CASE WHEN claimed + positives = 0 THEN 0 ELSE round(2 * hit / (claimed + positives), 6) END AS f1
FROM c"""
