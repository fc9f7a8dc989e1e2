"""A training corpus out of ``documents``: five stages, each written as Parquet and read again by the next.

Toxic documents go, then near copies but for one of each group, then documents contaminated by the benchmark. The rest is put in an
order in which the sources have their target weights, and written as token records in that order. The order lives
in the files of the fourth stage: their numbers, and the rows' places in them.

Every stage keeps whole rows with all their columns, gives no rows for an empty table, and treats nulls, repeated rows and long texts as
its operator's module says.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacurate.llm import decontaminate, mixing, queries, simhash, token_records, toxicity
from mediacurate.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, queries.table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mix."""
    mixed = mixing.mix(docs.select(F.struct("*").alias("_whole"), "source", "doc_id"))
    placed = mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return placed.select("_whole.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records in the order of the rows in the files of ``docs``, or of the ids if it has no files."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("bigint")
    keys = [part.alias("_part"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")]
    try:
        docs, order = docs.select("doc_id", "text", *keys), ("_part", "_file", "_at")
    except AnalysisException:  # rows that come from no files
        order = ("doc_id",)
    return token_records.tokenized(docs, queries.tokenizer_path(), queries.END_ID, *order)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_records", write_tokens),
]

#: Neither a classifier nor fingerprints can be said in SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.schema(queries.TABLES["documents"]).parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
