"""Session helpers: reliable checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder: on a cluster a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="mediacurate-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def task_count(spark: SparkSession) -> int:
    """Tasks for work whose rows are light and whose steps are slow: listing, opening, fetching.

    Such stages are sized by number, since by bytes they would fold into one
    task. ``spark.mediacurate.tasks`` sets it, as it should where executors come
    and go; otherwise it follows the cores at hand.
    """
    return int(spark.conf.get("spark.mediacurate.tasks", None) or spark.sparkContext.defaultParallelism * 4)


def settle(df: DataFrame) -> DataFrame:
    """Fix the rows and their partitions in the reliable checkpoint folder."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_table(df: DataFrame, label: str) -> DataFrame:
    """Write a table once and read it back, so later branches share one computation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
