"""Frequencies of n-grams against plain counting, over rows cut into short stretches."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from replylane.functions.text import with_terms
from replylane.operators import tfidf


@pytest.mark.parametrize("ngrams", [(1, 2), (2, 3), (1, 1)])
def test_against_counting(spark, monkeypatch, ngrams):
    rnd = random.Random(8)
    words = ["aa", "bb", "Cé", "dd", "x", "ee_1"]
    texts = [None, "", "x", "aa", "aa aa aa aa"] + [
        " ".join(rnd.choices(words, k=rnd.randrange(9))) for _ in range(60)
    ]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    monkeypatch.setattr(tfidf, "TOKENS_AT_ONCE", 20)
    got = {r["term"]: (r["cf"], r["df"]) for r in tfidf.term_statistics(df, "text", ngrams).collect()}
    lists = [r["terms"] for r in with_terms(df, "text", "terms", ngrams).collect()]
    cf = Counter(t for terms in lists for t in terms)
    each = Counter(t for terms in lists for t in set(terms))
    assert got == {t: (cf[t], each[t]) for t in cf} | {"": (len(texts), len(texts))}


def test_terms_are_grouped_once_a_stretch(spark):
    """A thousand copies of a text reach the aggregate as one row a term, not one an occurrence."""
    df = spark.range(1000).select(F.lit("aa bb aa cc").alias("text")).coalesce(1)
    plan = tfidf.term_statistics(df, "text")
    assert "Generate" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert {r["term"]: r["cf"] for r in plan.collect()}["aa bb"] == 1000
