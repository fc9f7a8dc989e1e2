"""Incremental arrivals: shard files become batches of an output table, each key once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacurate.schemas import SHARD_META
from mediacurate.session import task_count
from mediacurate.sources.shards import unify_files


# The columns of Spark's binaryFile source; only the path is kept, so no content is read.
_FILE = "path string, modificationTime timestamp, length bigint, content binary"
# Where a row was read; the first one of a key counts. Not stored.
_ORDER = ["shard_file", "row_pos"]


def _existing(spark: SparkSession, target: str, schema: str | None = None) -> DataFrame | None:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(target)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def once_by_key(batch: DataFrame, known: DataFrame | None, order: list[str] | None = None) -> DataFrame:
    """First sight of each key: the first row of the batch in ``order``, none of the known keys.

    Without ``order`` the row that sorts first is taken. Rows without a key are left out.
    """
    named = batch.filter(F.col("key").isNotNull())
    others = [c for c in batch.columns if c != "key"]
    if others:
        first = F.min_by(F.struct(*others), F.struct(*(order or others))).alias("_first")
        fresh = named.groupBy("key").agg(first)
        fresh = fresh.select(*[F.col("key") if c == "key" else F.col("_first")[c].alias(c) for c in batch.columns])
    else:
        fresh = named.distinct()
    return fresh if known is None else fresh.join(known.select("key"), "key", "left_anti")


def _without_key(rows: DataFrame) -> DataFrame:
    """Audit entries of the files that hold rows without a key."""
    counts = rows.filter(F.col("key").isNull()).groupBy(F.col("shard_file").alias("path")).agg(F.count("*").alias("_rows"))
    note = F.format_string("%d rows without a key", "_rows").alias("error")
    return counts.select("path", F.lit(None).cast("string").alias("signature"), note)


def stream_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = SHARD_META,
    files_per_trigger: int = 1000,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Take in every shard file not seen before, some at a time, then stop.

    What streams is the file names. Each micro-batch reads its files as the
    batch job does, so files whose types differ are cast and an unreadable one
    goes to the audit (``<target>_audit``) in place of stopping the stream.
    Rows go to their own ``batch=<id>`` directory in overwrite mode; when a batch
    is replayed after a failure, its own earlier output is left out of the known
    keys, so nothing is lost or doubled. Rows without a key are left out and
    counted in the audit. No state is kept beyond the file log and the output table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # At most ``files_per_trigger`` names.
        names = [(row["path"],) for row in batch.collect()]
        found = session.createDataFrame(names, "path string")
        rows, audit = unify_files(found, schema, tasks=max(1, min(len(names), task_count(session))))
        noted = audit.unionByName(_without_key(rows))
        noted.write.mode("overwrite").parquet(f"{target}_audit/batch={batch_id}")
        rows = transform(rows) if transform else rows.select(*schema.names, *_ORDER)
        order = [c for c in _ORDER if c in rows.columns]
        known = _existing(session, target, "key string, batch bigint")
        if known is not None:
            known = known.filter(F.col("batch") != F.lit(batch_id))
        fresh = once_by_key(rows, known, order)
        fresh.drop(*_ORDER, "row_no").write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(source)
        .select("path")
    )
    query = (
        arrivals.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    taken = _existing(spark, target)
    if taken is not None:
        return taken
    placed = [T.StructField("shard_file", T.StringType()), T.StructField("row_pos", T.LongType())]
    blank = spark.createDataFrame([], T.StructType([*schema.fields, *placed, T.StructField("shard", T.StringType())]))
    kept = transform(blank) if transform else blank.select(*schema.names)
    return kept.drop(*_ORDER, "row_no").withColumn("batch", F.lit(None).cast("bigint"))
