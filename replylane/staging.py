"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage the durable way: it survives the loss of any executor and is
read back column by column. The folder is the one the cluster names in
``spark.checkpoint.dir``; a temporary folder is used only by a local session without one.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    existing = context.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    created = tempfile.mkdtemp(prefix="run-")
    context.setCheckpointDir(created)
    return created


_scope: ContextVar[str] = ContextVar("staging_scope", default="shared")


def _root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/replylane/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_root(spark)}/{_scope.get()}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and return the table read back from it."""
    spark = df.sparkSession
    target = path or new_path(spark, name)
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def clear(spark: SparkSession) -> None:
    """Remove every table this application has staged; results built on them must be written."""
    _remove(spark, _root(spark))


def let_go(spark: SparkSession) -> None:
    """Have the broadcasts, shuffles and plans of queries that are over removed now.

    Spark does so when the driver collects its garbage, which by itself it puts off as long as
    its heap can grow. What Python has held until a second ago may stay until the next time.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _remove(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end, when their results have been written."""
    name = uuid.uuid4().hex
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)
        _remove(spark, f"{_root(spark)}/{name}")
