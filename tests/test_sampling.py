import math
from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from replylane.operators import golden, sampling
from replylane.operators.shape import inline, mark_lowest


def labelled(spark, sizes):
    rows = [(f"{label}-{i}", label) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "pair_id string, weak_intent string")


def dated(spark, sizes):
    rows = [
        (f"{month}-{i}", None if month == "none" else f"{month}-03 10:00:00")
        for month, n in sizes.items() for i in range(n)
    ]
    df = spark.createDataFrame(rows, "pair_id string, t string")
    return df.select("pair_id", F.to_timestamp("t").alias("customer_time"))


def test_month_sizes_are_exact_and_half_even(spark):
    sizes = {"2017-01": 50, "2017-02": 25, "2017-03": 15, "2017-04": 1, "2017-05": 9, "none": 7}
    taken = sampling.month_sample(dated(spark, sizes), 10)
    months = Counter(r["pair_id"][:7] for r in taken.collect())
    # A tenth of 50, 25, 15, 1 and 9 rows: 5, 2 (of 2.5), 2 (of 1.5), 0 and 1.
    assert months == {"2017-01": 5, "2017-02": 2, "2017-03": 2, "2017-05": 1}
    again = sampling.month_sample(dated(spark, sizes), 10)
    assert taken.exceptAll(again).count() == 0
    other = sampling.month_sample(dated(spark, sizes), 10, seed=7)
    assert other.exceptAll(taken).count() > 0


def test_quota_sample(spark):
    df = labelled(spark, {"a": 30, "b": 3, "d": 5})
    got = sampling.quota_sample(df, "weak_intent", {"a": 4, "b": 10, "c": 5})
    assert Counter(r["weak_intent"] for r in got.collect()) == {"a": 4, "b": 3}


def largest_remainder(sizes, fraction):
    n = sum(sizes.values())
    n_train = n - math.ceil(fraction * n)
    whole = {k: v * n_train // n for k, v in sizes.items()}
    order = sorted(sizes, key=lambda k: (-(sizes[k] * n_train % n), k))
    for k in order[: n_train - sum(whole.values())]:
        whole[k] += 1
    return {k: sizes[k] - whole[k] for k in sizes if sizes[k] - whole[k]}


def test_split_sizes(spark):
    sizes = {"a": 301, "b": 77, "c": 18, "d": 4}
    split = sampling.stratified_split(labelled(spark, sizes), "weak_intent")
    assert split.count() == 400 and split.select("pair_id").distinct().count() == 400
    held_out = Counter(r["weak_intent"] for r in split.where("is_validation").collect())
    assert held_out == largest_remainder(sizes, 0.1) and sum(held_out.values()) == 40


@settings(max_examples=5, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(1, 40), min_size=2))
def test_split_sizes_for_any_labels(spark, sizes):
    split = sampling.stratified_split(labelled(spark, sizes), "weak_intent", 0.25)
    held_out = Counter(r["weak_intent"] for r in split.where("is_validation").collect())
    assert held_out == largest_remainder(sizes, 0.25)


def test_mark_lowest_ranks_only_by_the_hash(spark):
    """Few leading digits put many rows on the edge; the result must not depend on it."""
    df = labelled(spark, {"a": 200, "b": 10})

    def quota_of(sizes):
        return sizes.select("weak_intent", F.lit(15).alias("quota"))

    hashed = sampling.digest("pair_id", 1)
    want = {
        r["pair_id"]
        for label in "ab"
        for r in df.where(F.col("weak_intent") == label).orderBy(hashed).limit(15).collect()
    }
    for digits in (1, 4):
        marked = mark_lowest(df, "weak_intent", hashed, F.col("pair_id"), quota_of, "m", digits)
        assert {r["pair_id"] for r in marked.where("m").collect()} == want
        assert marked.count() == 210


def test_exclusion_is_null_safe(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "pair_id string")
    ids = spark.createDataFrame([("a",), (None,)], "pair_id string")
    assert {r["pair_id"] for r in sampling.exclude_ids(df, ids).collect()} == {"b", None}


def test_inline(spark):
    table = inline(spark.range(1), [(1, "x"), (2, "y")], ["n", "s"])
    assert [tuple(r) for r in table.collect()] == [(1, "x"), (2, "y")]


def test_golden_round(spark):
    import pytest

    pairs = labelled(spark, {"a": 9, "b": 9}).select(
        "pair_id", "weak_intent", F.lit("text").alias("customer_clean"),
        F.lit("reply").alias("agent_clean"), F.current_timestamp().alias("customer_time"),
    )
    template = golden.golden_template(pairs, {"a": 4, "b": 4})
    assert template.where("gold_intent = '' and labeled_by = ''").count() == 8
    ids = sorted(r["pair_id"] for r in template.collect())
    labels = spark.createDataFrame(
        [(i, "a", "auto", "why") for i in ids] + [("gone", "b", "auto", "why")],
        "pair_id string, gold_intent string, gold_escalate string, gold_reason string",
    )
    assert [r["pair_id"] for r in golden.stale_labels(template, labels).collect()] == ["gone"]
    merged = golden.merge_labels(template, labels, "v0")
    assert merged.where("gold_intent = 'a' and labeled_by = 'v0'").count() == 8
    lacking = labels.where(F.col("pair_id") != ids[0])
    with pytest.raises(ValueError, match=f"1 pair ids.*{ids[0]}"):
        golden.merge_labels(template, lacking, "v0")

    reviews = spark.createDataFrame(
        [
            (ids[0], "b", "", None, "2024-01-01 00:00:00"),
            (ids[0], " ", "escalate", "new", "2024-01-02 00:00:00"),
            (ids[1], None, "", " ", "2024-01-01 00:00:00"),
        ],
        "pair_id string, gold_intent string, gold_escalate string, gold_reason string, t string",
    ).withColumn("reviewed_at", F.to_timestamp("t"))
    done = {r["pair_id"]: r for r in golden.apply_reviews(merged, reviews).collect()}
    assert len(done) == 8
    first, second, third = (done[i] for i in ids[:3])
    assert (first["gold_intent"], first["gold_escalate"], first["gold_reason"]) == ("a", "escalate", "new")
    assert (second["gold_intent"], second["labeled_by"]) == ("a", "human_review")
    assert third["labeled_by"] == "v0"
    assert golden.unlabelled(template).count() == 8 and golden.unlabelled(merged).count() == 0
