"""The registered queries of the training-data operators, one thin wrapper for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from replylane.llm import (
    alignment, bpe, decontam, line_dedup, mixing, ngram_join, packing, pii, quality, quality_rules,
    spelling, toxicity, warc,
)
from replylane.llm.words import bound_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class and its number of links."""
    found = ngram_join.find_classes(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, _table(spark, sf_dir, "labels")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, _table(spark, sf_dir, "labels")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.read_packs(packing.write_packs(_table(spark, sf_dir, "documents")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages")))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of its lines, of those removed, and the numbers of those kept."""
    found = line_dedup.kept_lines(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_worded") - F.size("kept")).cast("long").alias("n_removed"),
        F.array_join("kept", ",").alias("kept"),
    )


OP6_SQL = """
WITH l AS (
  SELECT doc_id, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i,
    unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents
), w AS (
  SELECT doc_id, i, list_sort(list_distinct(list_filter(
    regexp_split_to_array(line, '[ \t\x0B\f\r]+'), lambda x: x <> ''))) AS words FROM l
), s AS (
  SELECT words, len(words) AS n, min((doc_id, i)) AS place, row_number() OVER () AS id
  FROM w WHERE len(words) > 0 GROUP BY words
), t AS (SELECT id, n, place, unnest(words) AS word FROM s WHERE n >= 4),
f AS (SELECT word, count(*) AS df FROM t GROUP BY word),
p AS (
  SELECT * FROM t JOIN f USING (word)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY df, word) <= n - CAST(ceil(n * 4 / 5.0) AS BIGINT) + 1
), c AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b USING (word)
  WHERE a.place < b.place AND least(a.n, b.n) * 5 >= greatest(a.n, b.n) * 4
), gone AS (
  SELECT DISTINCT c.b FROM c JOIN s x ON x.id = c.a JOIN s y ON y.id = c.b
  WHERE len(list_intersect(x.words, y.words)) * 9 >= (x.n + y.n) * 4
), k AS (
  SELECT place[1] AS doc_id, string_agg(CAST(place[2] AS VARCHAR), ',' ORDER BY place[2]) AS kept,
    count(*) AS n_kept
  FROM s WHERE id NOT IN (SELECT b FROM gone) GROUP BY 1
), d AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE len(words) > 0) AS n FROM w GROUP BY 1)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  coalesce(kept, '') AS kept
FROM d LEFT JOIN k USING (doc_id)
"""

MIX = mixing.Target(
    domains={"d0": 2, "d1": 1}, languages={"en": 4, "de": 2, "fr": 2, "es": 1}
)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen documents by epoch; their texts are left out of the result."""
    return mixing.mix(_table(spark, sf_dir, "documents"), MIX).select(
        "doc_id", "domain", "lang", "source", "epoch", "n_tokens"
    )


OP7_SQL = """
WITH d AS (
  SELECT doc_id, lang, source, coalesce(lang, '') AS l, coalesce(source, '') AS s,
    CASE WHEN substr(md5(coalesce(source, '')), 1, 1) < '8' THEN 'd0' ELSE 'd1' END AS domain,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS n_tokens
  FROM documents
), s0 AS (
  SELECT domain, l, s, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(2 * sum(n_tokens) AS BIGINT) AS cap
  FROM d GROUP BY ALL
), l0 AS (SELECT domain, l, CAST(sum(cap) AS BIGINT) AS cap FROM s0 GROUP BY ALL),
d0 AS (
  SELECT domain, CAST(sum(cap) AS BIGINT) AS cap, CASE domain WHEN 'd0' THEN 2 ELSE 1 END AS w,
    (SELECT CAST(sum(tokens) AS BIGINT) FROM s0) AS total
  FROM l0 GROUP BY domain
), d1 AS (
  SELECT *, cap <= w * CAST(total - coalesce(sum(cap) OVER (ORDER BY cap / w, domain
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f
  FROM d0
), d2 AS (
  SELECT domain, CAST(CASE WHEN f THEN cap ELSE floor(CAST(total
      - coalesce(sum(cap) FILTER (WHERE f) OVER (), 0) AS DOUBLE)
    / sum(w) FILTER (WHERE NOT f) OVER () * w) END AS BIGINT) AS budget FROM d1
), l1 AS (
  SELECT l0.*, budget AS total,
    CASE l WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w
  FROM l0 JOIN d2 USING (domain)
), l2 AS (
  SELECT *, cap <= w * CAST(total - coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / w, l
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(w) OVER (PARTITION BY domain ORDER BY cap / w, l
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f
  FROM l1
), l3 AS (
  SELECT domain, l, CAST(CASE WHEN f THEN cap ELSE floor(CAST(total
      - coalesce(sum(cap) FILTER (WHERE f) OVER (PARTITION BY domain), 0) AS DOUBLE)
    / sum(w) FILTER (WHERE NOT f) OVER (PARTITION BY domain) * w) END AS BIGINT) AS budget FROM l2
), s1 AS (SELECT s0.*, budget AS total FROM s0 JOIN l3 USING (domain, l)), s2 AS (
  SELECT *, cap <= CAST(total - coalesce(sum(cap) OVER (PARTITION BY domain, l ORDER BY cap, s
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / count(*) OVER (PARTITION BY domain, l ORDER BY cap, s
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f
  FROM s1
), s3 AS (
  SELECT domain, l, s, tokens, CAST(CASE WHEN f THEN cap ELSE floor(CAST(total
      - coalesce(sum(cap) FILTER (WHERE f) OVER (PARTITION BY domain, l), 0) AS DOUBLE)
    / count(*) FILTER (WHERE NOT f) OVER (PARTITION BY domain, l)) END AS BIGINT) AS budget FROM s2
), k AS (
  SELECT d.*, budget // tokens AS whole, budget % tokens AS rest,
    md5('7:' || (budget // tokens + 1) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM d JOIN s3 USING (domain, l, s) WHERE tokens > 0
), r AS (
  SELECT *, whole + CAST(sum(n_tokens) OVER (PARTITION BY domain, l, s ORDER BY key
    ROWS UNBOUNDED PRECEDING) <= rest AS INTEGER) AS copies FROM k
)
SELECT doc_id, domain, lang, source, CAST(unnest(range(1, copies + 1)) AS BIGINT) AS epoch, n_tokens
FROM r
"""


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches (doc_id, item_id, start, end, distance); documents without one have no row."""
    return decontam.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect_personal_data(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = quality_rules.train(documents, _table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(documents, model)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.misspelt_words(_table(spark, sf_dir, "documents"))
    return spelling.variants(spelling.vocabulary(words))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(_table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        digest.alias("groups_sha256"),
    )


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode its ids again, and digest both."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(documents))
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_decontaminate": op8_decontaminate,
    "op9_pii": op9_pii,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling": op11_spelling,
    "op12_alignment": op12_alignment,
    "op13_bpe": op13_bpe,
}

ORACLE_SQL: dict[str, str] = {
    "op6_line_dedup": OP6_SQL,
    "op7_mixing": OP7_SQL,
}
