"""One query per operator with production parameters, over the whole of its table."""

from __future__ import annotations

import importlib.util
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from mediacurate.llm import (
    decontaminate,
    exact_dedup,
    importance,
    jaccard_join,
    line_dedup,
    mixing,
    quality,
    simhash,
    suffix_dedup,
    token_records,
    toxicity,
    warc,
    whitening,
)

TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
#: The public tokenizer of the token records and its end id.
TOKENIZER, END_ID = "word_bpe_49k.json", 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public vocabulary files are installed."""
    spec = importlib.util.find_spec("public_tokenizers")
    if spec is None:
        return str(Path("/opt/tokenizers") / name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_records.tokenized(docs, tokenizer_path(), END_ID).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages"), least=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("items")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, frame=mixing.FRAME)  # as its SQL says; the pipeline takes the target weights as they are


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_records,
        op2_suffix_dedup,
        op3_line_dedup,
        op4_exact_dedup,
        op5_simhash,
        op6_warc,
        op7_toxicity,
        op8_decontaminate,
        op9_mix,
        op10_quality,
        op11_jaccard_join,
        op12_whitening,
        op13_importance,
    )
}
