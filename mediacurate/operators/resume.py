"""Resume, batch commits and the complete table.

The state is the output: a log of the committed batches, and the keys in them, which are the processed ones.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacurate.operators.metadata import last_by_key
from mediacurate.operators.numbering import batch_names
from mediacurate.schemas import CAPTIONED
from mediacurate.sources.commits import CommitLog

# A stored row: the published columns, why it failed if it did, and its batch.
STORED = T.StructType(
    CAPTIONED.fields + [T.StructField("error", T.StringType()), T.StructField("batch_id", T.LongType())]
)


_COMMITTED = "batch_id bigint, rows bigint, captioned bigint, path string"


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows of a folder of batches; no rows when nothing was written yet."""
    try:
        return spark.read.schema(STORED).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)


def write_batches(rows: DataFrame, path: str) -> None:
    """Write whole batches; one that is written again replaces itself."""
    (
        rows.select(*STORED.names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def commit_log(spark: SparkSession, path: str) -> CommitLog:
    """The log of the batches committed to ``path``."""
    return CommitLog(spark, f"{path.rstrip('/')}/_commits", _COMMITTED)


def _at(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The rows of some directories of ``path``; no other is listed."""
    if not names:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).option("basePath", path).parquet(*[f"{path}/{name}" for name in sorted(names)])


def commit_batches(rows: DataFrame, path: str, batches: range) -> DataFrame:
    """Write the rows of ``batches`` and commit them; the rows as they were written.

    A batch whose rows were written but not committed, by a run that crashed, is not read by anyone; the next run uses its
    number again and replaces it.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    write_batches(rows, path)
    written = _at(spark, path, [f"batch_id={b}" for b in batches])
    counts = written.groupBy("batch_id").agg(
        F.count("*").alias("rows"), F.count_if(F.col("error").isNull()).alias("captioned")
    )
    # One line per batch of the round.
    lines = [r.asDict() | {"path": f"batch_id={r['batch_id']}"} for r in counts.orderBy("batch_id").collect()]
    commit_log(spark, path).append(lines)
    return written


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the committed batches, found by the log and not by a listing.

    A folder that an earlier run left without a log is taken as it is: its batches are committed first.
    """
    path, log = path.rstrip("/"), commit_log(spark, path)
    if not log.versions():
        left = read_batches(spark, path)
        counts = left.groupBy("batch_id").agg(F.count("*").alias("rows"), F.count_if(F.col("error").isNull()).alias("captioned"))
        lines = [r.asDict() | {"path": f"batch_id={r['batch_id']}"} for r in counts.orderBy("batch_id").collect()]
        if not lines:
            return left
        log.append(lines)
    return _at(spark, path, [r["path"] for r in log.entries().select("path").distinct().collect()])


def next_batch_id(stored: DataFrame) -> int:
    """One past the highest batch of ``stored``: rows with a batch_id, or the entries of a log."""
    highest = stored.agg(F.max("batch_id")).first()[0]
    return 0 if highest is None else highest + 1


def captioned(stored: DataFrame) -> DataFrame:
    return stored.filter(F.col("error").isNull())


def rejected(stored: DataFrame) -> DataFrame:
    return stored.filter(F.col("error").isNotNull()).select("key", "error", "batch_id")


def processed_keys(*key_tables: DataFrame) -> DataFrame:
    """Distinct keys of any number of tables that have a ``key`` column."""
    united = None
    for table in key_tables:
        if "key" not in table.columns:
            continue
        keys = table.select("key").filter(F.col("key").isNotNull())
        united = keys if united is None else united.union(keys)
    if united is None:
        raise ValueError("no table with a key column")
    return united.distinct()


def pending(assets: DataFrame, processed: DataFrame) -> DataFrame:
    """Assets whose key is not processed. Broadcast or shuffle is left to the sizes Spark measures."""
    return assets.join(processed.select("key"), "key", "left_anti")


def skip_counts(assets: DataFrame, processed: DataFrame) -> DataFrame:
    """How many assets are skipped and how many are to do."""
    done = processed.select("key", F.lit(True).alias("_done")).distinct()
    per_key = assets.groupBy("key").agg(F.count("*").alias("_rows"))
    rows, known = F.col("_rows"), F.col("_done").isNotNull()
    return per_key.join(done, "key", "left").agg(
        F.coalesce(F.sum(F.when(known, rows)), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.when(~known, rows)), F.lit(0)).alias("to_do"),
    )


_PUBLISHED = "directory string, replaces boolean"


def snapshots(spark: SparkSession, path: str) -> CommitLog:
    """The versions of a published folder: directories that came with each, in addition to or in place of those before."""
    return CommitLog(spark, f"{path.rstrip('/')}/_snapshots", _PUBLISHED)


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows that the latest version, or an earlier one, shows; none before the first."""
    entries = snapshots(spark, path).entries()
    if version is not None:
        entries = entries.filter(F.col("version") <= version)
    since = entries.filter("replaces").agg(F.max("version")).first()[0] or 0
    names = sorted(r["directory"] for r in entries.filter(F.col("version") >= since).select("directory").distinct().collect())
    schema = T.StructType([*CAPTIONED.fields, T.StructField("publish_name", T.StringType())])
    if not names:
        return spark.createDataFrame([], schema)
    base = path.rstrip("/")
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{name}" for name in names])


def publish(stored: DataFrame, path: str, rows_per_batch: int) -> DataFrame:
    """Copy the full batches under their publish names and show them in a new version; returns the publish manifest.

    Short batches end a run, so there is one per run: their numbers are held on
    the driver and prune the partitions read, and the rows are not shuffled.
    """
    sizes = stored.groupBy("batch_id").agg(F.count("*").alias("rows"))
    short = [row["batch_id"] for row in sizes.filter(F.col("rows") < rows_per_batch).select("batch_id").collect()]
    rows = captioned(stored.filter(~F.col("batch_id").isin(short)) if short else stored)
    name = F.format_string("batch_%05d", F.col("batch_id") + 1)
    (
        rows.select(*CAPTIONED.names, name.alias("publish_name"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("publish_name")
        .parquet(path)
    )
    manifest = publish_manifest(stored, path, rows_per_batch)
    # One name per batch; a batch of rejects alone has no directory.
    shown = [r["path"].rsplit("/", 1)[-1] for r in manifest.filter("rows > 0").select("path").collect()]
    if shown:
        snapshots(stored.sparkSession, path).append([{"directory": d, "replaces": False} for d in sorted(shown)])
    return manifest


def publish_manifest(stored: DataFrame, path: str, rows_per_batch: int) -> DataFrame:
    """One row per published batch: batch, rows that went out, where."""
    counts = stored.groupBy("batch_id").agg(
        F.count("*").alias("rows"), F.count_if(F.col("error").isNull()).alias("published_rows")
    )
    named = batch_names(counts, rows_per_batch, "published_rows").filter(F.col("publish_name").isNotNull())
    return named.select(
        "batch_id",
        F.col("published_rows").alias("rows"),
        F.concat(F.lit(path.rstrip("/") + "/publish_name="), "publish_name").alias("path"),
    )


def publish_complete(complete: DataFrame, path: str) -> DataFrame:
    """End a run: the complete table, short batches included, becomes the folder's next version.

    It is written beside the batches, which stay, and readers of ``read_published`` go over to it at once when its version is
    made; until then, or if the run fails before, they read what was there.
    """
    spark, log = complete.sparkSession, snapshots(complete.sparkSession, path)
    name = f"publish_name=complete-{uuid.uuid4().hex}"
    complete.select(*CAPTIONED.names).write.parquet(f"{path.rstrip('/')}/{name}")
    log.append([{"directory": name, "replaces": True}])
    return read_published(spark, path)


def complete_table(stored: DataFrame) -> DataFrame:
    """Every captioned key once, the latest batch winning."""
    latest = last_by_key(captioned(stored), ["key"], ["batch_id"])
    return latest.select(*CAPTIONED.names)
