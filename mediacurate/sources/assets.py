"""Listing the files of a dataset.

Spark's own file sources list on the driver, which cannot hold hundreds of
millions of entries. Here tasks list, and directories are rows of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacurate.functions import layout
from mediacurate.operators.numbering import global_index
from mediacurate.schemas import IMAGE_EXTENSIONS, SOURCE_ROWS
from mediacurate.session import settle_table, task_count
from mediacurate.sources import files

# Above this many rows a top-n is taken by position, not held in one task.
TOP_N_IN_ONE_TASK = 10_000


def list_level(directories: DataFrame, tasks: int) -> DataFrame:
    """Direct children of ``directories`` (path): path, is_dir, length. Each directory is listed by one of ``tasks`` tasks."""

    def work(frames):
        for frame in frames:
            rows = (child for uri in frame["path"] for child in files.children(uri))
            yield from files.in_frames(rows, ["path", "is_dir", "length"])

    return directories.select("path").repartition(tasks, "path").mapInPandas(work, "path string, is_dir boolean, length bigint")


def list_directory(spark: SparkSession, root: str) -> DataFrame:
    """Direct children of ``root``: path, is_dir, length."""
    return list_level(spark.createDataFrame([(layout.normalise_root(root),)], "path string"), 1)


def list_files(
    spark: SparkSession, root: str, only: Column | None = None, parallelism: int | None = None
) -> DataFrame:
    """Every file under ``root``, at any depth: path, length. Empty files included.

    The tree is listed level by level: the directories that one level has are spread over the tasks anew and give the
    next, until a level has none. So many tasks list a deep tree, whatever directory it hangs from.
    ``only`` is a condition on the direct children of ``root`` (path, is_dir) that are followed.
    """
    tasks = parallelism or task_count(spark)
    top = list_directory(spark, root)
    level = settle_table(top if only is None else top.filter(only), "level")
    found = level
    while not (directories := level.filter("is_dir")).isEmpty():
        level = settle_table(list_level(directories, tasks), "level")
        found = found.union(level)
    return found.filter("NOT is_dir").select("path", "length")


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """The source table, with the position of each row: its file and its place in it."""
    rows = spark.read.schema(SOURCE_ROWS).parquet(path)
    return rows.select(
        "*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("source_row")
    )


def with_layout(listing: DataFrame) -> DataFrame:
    """Add shard, key and ext, all read off the path."""
    path = F.col("path")
    return listing.withColumns(
        {"shard": layout.parent(path), "key": layout.stem(path), "ext": layout.extension(path)}
    )


def image_assets(listing: DataFrame, extensions=IMAGE_EXTENSIONS, shard_dirs_only: bool = False) -> DataFrame:
    """Keep image files; optionally only those in directories named by digits.

    Extensions are compared as written, upper case being another extension.
    """
    wanted: Column = F.col("ext").isin(*extensions)
    if shard_dirs_only:
        wanted = wanted & layout.is_shard_name(F.col("shard"))
    return with_layout(listing).filter(wanted)


def list_assets(spark: SparkSession, root: str, extensions=IMAGE_EXTENSIONS, shard_dirs_only: bool = False) -> DataFrame:
    """Image files under ``root``; ``shard_dirs_only`` stays directly inside its shard directories."""
    if not shard_dirs_only:
        return image_assets(list_files(spark, root), extensions)
    shard_dir = F.col("is_dir") & layout.is_shard_name(layout.base_name(F.col("path")))
    direct = layout.relative_path(F.col("path"), root).rlike("^[0-9]+/[^/]+$")
    return image_assets(list_files(spark, root, shard_dir).filter(direct), extensions, shard_dirs_only=True)


def discover_shards(listing: DataFrame) -> DataFrame:
    shard = layout.parent(F.col("path"))
    return listing.select(shard.alias("shard")).filter(layout.is_shard_name(F.col("shard"))).distinct()


def limit_assets(assets: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` by path; none and zero both mean all."""
    if not n:
        return assets
    if n <= TOP_N_IN_ONE_TASK:
        return assets.orderBy("path").limit(n)
    return global_index(assets, "path").filter(F.col("gidx") < n).drop("gidx")
