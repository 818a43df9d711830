"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores. Every result is
written to the no-op sink, so all rows and columns are produced. The shared inputs (pairs,
case index, classifier) are built first and timed as entries of their own.
"""

from __future__ import annotations

import json
import os
import time

from replylane.registry import batch, inputs
from replylane.session import build_session

HEADLINES = (
    "clean_text", "html_decode", "weak_label", "escalation_decision", "decision_counts",
    "reply_join", "label_distribution", "first_copies", "month_sample", "quota_sample",
    "train_split", "merge_gold", "intent_metrics", "class_report", "confusion_matrix",
    "escalation_metrics", "ngrams", "tfidf_vocab", "tfidf_weights", "retrieve_topk",
    "retrieve_fallback", "triage", "judge_kappa", "classify_scores", "evaluate_intents",
    "triage_model", "stream_decisions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    timed("build_pairs", lambda: inputs.labelled_pairs(spark, sf_dir))
    timed("build_case_index", lambda: inputs.case_index(spark, sf_dir))
    timed("train_classifier", lambda: inputs.model(spark, sf_dir))
    timed("train_language_classifier", lambda: inputs.language_model(spark, sf_dir))
    for name in HEADLINES:
        timed(name, lambda: batch.QUERIES[name](spark, sf_dir)
              .write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
