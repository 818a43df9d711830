"""Questions to a slow or failing outside service, asked once and answered whenever.

A question is known by the digest of its prompt. What was asked and what came back are tables
in a folder, only ever added to; who answers, and how often it fails, is not known here. Asking
again for the same rows hands out only prompts that have no answer yet, so a run that was
stopped, or whose answers came in part, goes on where it was. Answers that come late, twice or
in any order give the same result: of one prompt's answers the first that is no error stands.

Tables: ``asked`` (prompt_key, prompt), ``answers`` (prompt_key, response, error, received).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ASKED = "prompt_key string, prompt string"
ANSWERS = "prompt_key string, response string, error string, received long"


def prompt_key(prompt: Column) -> Column:
    return F.md5(prompt)


def best_answers(answers: DataFrame) -> DataFrame:
    """(prompt_key, response, error): the first answer without error, else the last error.

    An aggregate, combined before the shuffle; answers received together go by their text.
    """
    good = F.col("error").isNull() & F.col("response").isNotNull()
    first = F.min(F.when(good, F.struct("received", "response"))).alias("first")
    last = F.max(F.when(~good, F.struct("received", F.coalesce("error", F.lit("empty answer")).alias("error")))).alias("last")
    return answers.groupBy("prompt_key").agg(first, last).select(
        "prompt_key", F.col("first.response").alias("response"),
        F.when(F.col("first").isNull(), F.col("last.error")).alias("error"),
    )


def unanswered(questions: DataFrame, answers: DataFrame, retry_errors: bool = True) -> DataFrame:
    """The distinct (prompt_key, prompt) of ``questions`` that still need an answer."""
    done = best_answers(answers)
    if retry_errors:
        done = done.where("response is not null")
    distinct = questions.select("prompt_key", "prompt").dropDuplicates(["prompt_key"])
    return distinct.join(done.select("prompt_key"), "prompt_key", "left_anti")


@dataclass(frozen=True)
class Exchange:
    """The tables of an exchange, in a shared folder."""

    spark: SparkSession
    path: str

    def _table(self, name: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{name}"
        self.spark.createDataFrame([], schema).write.mode("append").parquet(folder)
        return self.spark.read.schema(schema).parquet(folder)

    @property
    def answers(self) -> DataFrame:
        return self._table("answers", ANSWERS)

    @property
    def asked(self) -> DataFrame:
        """Everything handed out so far; a prompt that was asked again is there again."""
        return self._table("asked", ASKED)

    def ask(self, questions: DataFrame, retry_errors: bool = True) -> DataFrame:
        """Hand out what needs an answer; the rows are written before they are returned."""
        opened = unanswered(questions, self.answers, retry_errors)
        batch = f"{self.path}/batches/{uuid.uuid4().hex}"
        opened.write.parquet(batch)
        found = self.spark.read.schema(ASKED).parquet(batch)
        found.write.mode("append").parquet(f"{self.path}/asked")
        return found

    def receive(self, answers: DataFrame) -> None:
        """Add answers (prompt_key, response, error, received), late and repeated ones as well."""
        wanted = answers.select(
            "prompt_key", F.col("response").cast("string"), F.col("error").cast("string"),
            F.col("received").cast("long"),
        )
        wanted.write.mode("append").parquet(f"{self.path}/answers")

    def results(self, questions: DataFrame) -> DataFrame:
        """``questions`` with the response, or error, that their prompt has by now."""
        return questions.join(best_answers(self.answers), "prompt_key", "left")
