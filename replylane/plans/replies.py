"""Reply-quality judging end to end; an outside judge answers the prompts in between."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from replylane.functions.drafting import judge_prompt
from replylane.operators.exchange import Exchange, prompt_key
from replylane.operators.judging import (
    judge_kappa, judge_means, judged_replies, mean_difference, with_human,
)
from replylane.operators.retrieval import CaseIndex
from replylane.operators.sampling import first_rows
from replylane.plans.training import IntentModel
from replylane.plans.triage import Desk, triage
from replylane.staging import stage


@dataclass(frozen=True)
class Judgement:
    scores: DataFrame
    means: DataFrame
    differences: DataFrame | None
    kappas: DataFrame | None


def judge_requests(
    golden: DataFrame, n: int, model: IntentModel, index: CaseIndex, desk: Desk
) -> DataFrame:
    """Drafts for the first ``n`` golden rows, each with the prompt for the judge."""
    asked = first_rows(golden, n, "pair_id").select(
        F.col("pair_id").alias("id"), F.col("customer_clean").alias("text")
    )
    drafted = triage(asked, model, index, desk)
    prompt = judge_prompt(F.col("text"), F.col("hits"), F.col("draft_reply"), desk.brand)
    return drafted.select(
        F.col("id").alias("pair_id"), F.col("text").alias("customer_clean"), "draft_reply",
        prompt.alias("prompt"),
    )


def ask_judge(requests: DataFrame, exchange: Exchange) -> DataFrame:
    """The prompts (prompt_key, prompt) of ``judge_requests`` that still need an answer."""
    return exchange.ask(requests.withColumn("prompt_key", prompt_key(F.col("prompt"))))


def judge_answered(
    requests: DataFrame, exchange: Exchange, human: DataFrame | None = None
) -> Judgement:
    """``judge`` over the answers there are by now; what has none yet is left out."""
    keyed = requests.withColumn("prompt_key", prompt_key(F.col("prompt")))
    answered = exchange.results(keyed).where("response is not null").select("pair_id", "response")
    return judge(requests, answered, human)


def judge(requests: DataFrame, responses: DataFrame, human: DataFrame | None = None) -> Judgement:
    """Scores from the judge's answers (pair_id, response), and agreement with people's."""
    scores = stage(judged_replies(requests, responses), "scores")
    both = None if human is None else with_human(scores, human)
    return Judgement(
        scores=scores,
        means=judge_means(scores),
        differences=None if both is None else mean_difference(both),
        kappas=None if both is None else judge_kappa(both),
    )
