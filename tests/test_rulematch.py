"""Large rule tables against every pattern on every text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from replylane.functions.rules import RuleSet, match_table
from replylane.operators import rulematch


@pytest.mark.parametrize("pattern, literals", [
    ("refund", {"refund"}), (r"\bre(?:fund|imburse)\w*\b", {"fund", "imburse"}), ("abc|abd|xyz", {"abc", "abd", "xyz"}),
    ("(?i)refund", set()), (r"\d+", set()), ("a?b?", set()), ("(?:lost){2,} bag", {"lost"}),
    ("colou?r", {"colo"}), ("x*yes(no)?", {"yes"}), (r"\p{L}+ok", set()), ("[ab]cd", {"cd"}), ("ab|[cd]", set()),
    ("(", set()), ("", set()),
])
def test_literals_that_every_match_holds(pattern, literals):
    assert rulematch.required_literals(pattern) == literals


def test_random_rules_match_brute_force(spark):
    rng = random.Random(1)
    piece = lambda: rng.choice(["ab", "ba", "cab", "abba", "c", "dd"])
    shapes = [lambda: piece() + piece(), lambda: f"{piece()}(?:{piece()}|{piece()})", lambda: f"\\b{piece()}\\w*",
              lambda: f"{piece()}.{{0,2}}{piece()}", lambda: f"[{piece()}]+d", lambda: f"({piece()})?c", lambda: f"{piece()}+$",
              lambda: f"{piece()}|{piece()} {piece()}"]
    rules = [(i + 1, f"l{i % 7}", rng.choice(shapes)()) for i in range(300)]
    rules += [(5, "same", "abba"), (5, "same", "abba"), (6, "none", None)]
    texts = [(i, " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 5)))) for i in range(120)]
    texts += [(500, None), (501, ""), (502, "ABBA Cab")]
    df = spark.createDataFrame(texts, "id long, text string")
    table = spark.createDataFrame(rules, "priority int, label string, pattern string")
    got = rulematch.match_rule_table(df, "id", "text", table)
    want = [(i, p, l, x) for i, t in texts for p, l, x in rules if x is not None and re.search(x, (t or "").lower())]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    labels = {r.id: (r.label, r.priority) for r in rulematch.label_by_rule_table(df, "id", "text", table, "other").collect()}
    for i, _ in texts:
        first = min(((p, l) for j, p, l, _ in want if j == i), default=(None, "other"))
        assert labels[i] == (first[1], first[0])


def test_fifty_thousand_rules(spark, monkeypatch):
    monkeypatch.setattr(rulematch, "BLOCK_RULES", 30_000)
    rules = spark.range(50_000).select(
        (F.col("id") + 1).cast("int").alias("priority"), F.concat(F.lit("l"), F.col("id") % 9).alias("label"),
        F.concat(F.lit("\\bw"), "id", F.lit("x(?:s|ed)?\\b")).alias("pattern"))
    rows = [(i, f"some w{i * 977 % 50_000}x and W{i * 31}xed, not w{i}xy") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {(r.id, r.priority) for r in rulematch.match_rule_table(df, "id", "text", rules).collect()}
    assert got == {(i, i * 977 % 50_000 + 1) for i, _ in rows} | {(i, i * 31 + 1) for i, _ in rows}


def test_the_table_form_equals_the_expression(spark):
    rules = [(1, "refund", r"\brefund\w*"), (1, "refund", "money back"), (2, "bag", r"\b(lost|missing) bag")]
    table = spark.createDataFrame(rules, "priority int, label string, pattern string")
    df = spark.createDataFrame([(1, "Refunded my lost bag"), (2, "nothing"), (3, "MONEY BACK for the missing bag")], "id long, text string")
    want = match_table(df, "id", "text", RuleSet.from_table(table, "other"))
    got = rulematch.match_rule_table(df, "id", "text", table)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert rulematch.match_rule_table(df, "id", "text", table.limit(0)).count() == 0
    assert rulematch.match_rule_table(df.limit(0), "id", "text", table).count() == 0
