"""Shard metadata: many parquet files, one table, and an audit of what was left out."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacurate.functions import layout
from mediacurate.functions.text import to_int
from mediacurate.operators.metadata import row_number
from mediacurate.schemas import SHARD_META, SUCCESS
from mediacurate.session import settle_table, task_count
from mediacurate.sources import files
from mediacurate.sources.assets import list_files

_FOOTERS = "path string, signature string, fields string, rows bigint, error string"


def _type_name(dtype: pa.DataType) -> str:
    """The same text for types that read alike: dictionaries and large texts as what they hold."""
    if pa.types.is_dictionary(dtype):
        return _type_name(dtype.value_type)
    return str(dtype).removeprefix("large_")


def _footer(path: str) -> tuple:
    import pyarrow.parquet as pq

    try:
        with files.open_at(path) as handle:
            footer = pq.ParquetFile(handle)
            fields = json.dumps(sorted([f.name, _type_name(f.type)] for f in footer.schema_arrow))
            return path, hashlib.sha256(fields.encode()).hexdigest(), fields, footer.metadata.num_rows, None
    except Exception as problem:
        return path, None, None, None, f"{type(problem).__name__}: {problem}"


def list_shard_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths of the parquet files of ``root``. The directories of the assets beside them are not followed."""
    shard_entry = F.col("path").rlike(r"\.parquet$|/shard=[^/]+$")
    return list_files(spark, root, shard_entry).filter(F.col("path").endswith(".parquet")).select("path")


def read_footers(found: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per parquet file of ``found`` (path), from its footer: signature and fields of its columns, rows, error or null.

    Files have the same signature if their columns have the same names and types, in whatever order.
    """

    def work(frames):
        for frame in frames:
            yield pd.DataFrame([_footer(path) for path in frame["path"]], columns=["path", "signature", "fields", "rows", "error"]).astype({"rows": "Int64"})

    return found.repartition(tasks or task_count(found.sparkSession), "path").mapInPandas(work, _FOOTERS)


def shard_name(path: Column) -> Column:
    """``00007`` from ``00007.parquet`` or from a ``shard=00007`` directory."""
    by_dir = F.regexp_extract(path, r"shard=([^/]+)/", 1)
    return F.when(by_dir != "", by_dir).otherwise(F.regexp_extract(path, r"([^/]+)\.parquet(/[^/]*)?$", 1))


def _conform(df: DataFrame, schema: T.StructType, absent: str | None, keep_as_text: set[str]) -> DataFrame:
    """Cast to the canonical types; columns a file lacks become ``absent`` or null."""
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            value = F.col(field.name)
            if df.schema[field.name].dataType != field.dataType:
                value = to_int(value) if field.dataType == T.IntegerType() else value.cast(field.dataType)
        else:
            value = F.lit(absent if field.dataType == T.StringType() else None).cast(field.dataType)
        columns.append(value.alias(field.name))
    for name in df.columns:
        if name not in schema.names:
            columns.append(F.col(name).cast("string").alias(name) if name in keep_as_text else F.col(name))
    return df.select(*columns)


def unify_shards(
    spark: SparkSession,
    root: str,
    schema: T.StructType = SHARD_META,
    absent: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All shard files under ``root`` as one table, and the audit of the files themselves."""
    return unify_files(list_shard_files(spark, root), schema, absent)


def unify_files(
    found: DataFrame, schema: T.StructType = SHARD_META, absent: str | None = None, tasks: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The parquet files of ``found`` (path) as one table, and their audit (path, signature, error).

    Files are grouped by the columns that their footers name. Each group is scanned once, with its own types, cast to
    ``schema`` and written with the others; extra columns are kept. The scan passes over what it cannot read, and a file that gave
    fewer rows than its footer counts is left out as a whole. Rows carry ``shard``, ``shard_file`` and ``row_pos``, the order in
    which later rows win, and ``row_no``, a number that rises with it.

    The driver holds the names of the files, which Spark's scans need, and the columns of each group; never rows.
    """
    spark = found.sparkSession
    footers = settle_table(read_footers(found, tasks), "footers")
    groups = footers.filter(F.col("error").isNull()).groupBy("signature")
    fields = {r["signature"]: json.loads(r["fields"]) for r in groups.agg(F.min("fields").alias("fields")).collect()}
    kinds: dict[str, set[str]] = {}
    for name, dtype in (field for some in fields.values() for field in some):
        kinds.setdefault(name, set()).add(dtype)
    disputed = {name for name, several in kinds.items() if len(several) > 1}
    paths: dict[str, list[str]] = {}
    for row in footers.filter(F.col("error").isNull()).select("signature", "path").collect():
        paths.setdefault(row["signature"], []).append(row["path"])

    placed = [T.StructField("shard_file", T.StringType()), T.StructField("row_pos", T.LongType())]
    rows = spark.createDataFrame([], T.StructType([*schema.fields, *placed]))
    tolerant = {"mergeSchema": "false", "ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}
    for signature in sorted(paths):
        scan = spark.read.options(**tolerant).parquet(*sorted(paths[signature]))
        read = scan.select("*", F.col("_metadata.file_path").alias("shard_file"), F.col("_metadata.row_index").alias("row_pos"))
        rows = rows.unionByName(_conform(read, schema, absent, disputed), allowMissingColumns=True)
    names = sorted(path for some in paths.values() for path in some)
    numbers = spark.createDataFrame(list(enumerate(names)), "file_no bigint, _path string")
    numbers = numbers.select("file_no", layout.normalise_path(F.col("_path")).alias("_plain"))
    placed_rows = rows.withColumns({"shard": shard_name(F.col("shard_file")), "_plain": layout.decode_origin(F.col("shard_file"))})
    # One row per file; the driver and the scans hold the names as it is. Rows with their captions are not shuffled for it.
    numbered = placed_rows.join(F.broadcast(numbers), "_plain").withColumn("row_no", row_number(F.col("file_no"), F.col("row_pos")))
    rows = settle_table(numbered.drop("_plain", "file_no"), "shard-rows")

    counts = rows.groupBy("shard_file").agg(F.count("*").alias("_read"))
    counts = counts.select(layout.decode_origin(F.col("shard_file")).alias("_plain"), "shard_file", "_read")
    plain = footers.withColumn("_plain", layout.normalise_path(F.col("path")))
    told = plain.join(counts, "_plain", "left").withColumn("_read", F.coalesce("_read", F.lit(0)))
    short = F.when(F.col("_read") != F.col("rows"), F.format_string("unreadable: %d of %d rows", "_read", "rows"))
    told = settle_table(told.select("path", "signature", F.coalesce("error", short).alias("error"), "shard_file"), "shard-audit")
    damaged = told.filter(F.col("error").isNotNull() & F.col("shard_file").isNotNull()).select("shard_file")
    return rows.join(damaged, "shard_file", "left_anti").select(*rows.columns), told.drop("shard_file")


def success_captions(shard_rows: DataFrame) -> DataFrame:
    """Key and caption of the rows that were fetched."""
    order = [c for c in ("shard", "shard_file", "row_pos", "row_no") if c in shard_rows.columns]
    return shard_rows.filter(F.col("status") == SUCCESS).select("key", "caption", *order)


def shard_status(shard_rows: DataFrame) -> DataFrame:
    return shard_rows.groupBy("shard", "status").agg(F.count("*").alias("rows"))
