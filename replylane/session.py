"""Session settings the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The small minimum keeps compute-heavy stages parallel: a few kilobytes of rules, text or
# query terms can be a lot of work, which coalescing by bytes alone would put in one task.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``master`` stays the cluster's choice if unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_runtime(spark: SparkSession) -> SparkSession:
    """Apply the runtime-changeable settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
