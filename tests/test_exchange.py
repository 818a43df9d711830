"""Asking and answering in parts gives what asking once would."""

import random

from pyspark.sql import functions as F

from replylane.operators.exchange import ANSWERS, Exchange, best_answers, prompt_key, unanswered


def questions(spark, n=20):
    df = spark.createDataFrame([(i, f"prompt {i % 15}") for i in range(n)], "id long, prompt string")
    return df.withColumn("prompt_key", prompt_key(F.col("prompt")))


def reply(asked, keep, error=None, received=1):
    response = F.when(F.lit(error).isNull(), F.concat(F.lit("re: "), "prompt"))
    return asked.where(keep).select(
        "prompt_key", response.alias("response"), F.lit(error).alias("error"), F.lit(received).alias("received"))


def test_a_prompt_is_asked_until_it_is_answered(spark, tmp_path):
    exchange, df = Exchange(spark, str(tmp_path / "x")), questions(spark)
    first = exchange.ask(df)
    assert first.count() == 15
    odd = F.substring("prompt", 8, 9).cast("int") % 2 == 1
    exchange.receive(reply(first, odd))
    exchange.receive(reply(first, ~odd, "timeout"))
    second = exchange.ask(df)
    assert second.count() == 8 and second.join(first, "prompt_key", "left_anti").count() == 0
    assert exchange.ask(df, retry_errors=False).count() == 0
    # a stopped run that starts anew goes on, and late and repeated answers change nothing
    again = Exchange(spark, str(tmp_path / "x"))
    again.receive(reply(second, F.lit(True), received=5))
    again.receive(reply(first, odd, received=9))
    again.receive(reply(first, F.lit(True), "timeout", 9))
    assert again.ask(df).count() == 0
    rows = again.results(df).collect()
    assert len(rows) == 20 and all(r.response == f"re: prompt {r.id % 15}" and r.error is None for r in rows)
    assert again.asked.select("prompt_key").distinct().count() == 15


def test_order_of_arrival_does_not_matter(spark):
    rng = random.Random(2)
    rows = [(f"k{i % 4}", rng.choice(["a", "b", None]), rng.choice([None, "e1", "e2"]), rng.randrange(5)) for i in range(60)]
    df = spark.createDataFrame(rows, ANSWERS)
    want = {}
    for key in {r[0] for r in rows}:
        good = sorted((t, x) for k, x, e, t in rows if k == key and e is None and x is not None)
        bad = sorted((t, e or "empty answer") for k, x, e, t in rows if k == key and not (e is None and x is not None))
        want[key] = (good[0][1], None) if good else (None, bad[-1][1])
    for parts in (1, 7):
        assert {r.prompt_key: (r.response, r.error) for r in best_answers(df.repartition(parts)).collect()} == want


def test_empty_tables(spark, tmp_path):
    exchange, df = Exchange(spark, str(tmp_path / "x")), questions(spark).limit(0)
    assert exchange.ask(df).count() == 0 and exchange.results(df).count() == 0
    assert unanswered(questions(spark, 3), exchange.answers).count() == 3
