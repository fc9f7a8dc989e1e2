"""Exact dedup by skew-safe combining, with built-in expressions only.

Rows are combined three times: map-side within a task, then per salt of a digest, then over the salts of a digest.
Every one of these groupings has the whole normalised text among its keys, so equal digests never merge unequal texts;
the digest only makes the verdict cheap to bring back to the rows. Combining moves a text once per task that holds it,
so a group with a third of all rows reaches a reducer as at most one row per task and salt. The verdict goes back by digest
and salt too, once for each salt that the group has, so the rows of a hot group never meet in one task.

Defined results: a null text counts as empty; a null id sorts after every other id, and stays only when all rows of
its group with the most code points have none; rows that repeat an id are counted each and share its verdict; an empty table gives no rows;
columns beside the two named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
#: At most 64: the salts of a group are the bits of one number.
SALTS = 64
_TOP = 2**63 - 1
_SHIFT = 10**20  # more than the range of a 64-bit id


def without_white(text: Column) -> Column:
    """``text`` without blanks and the control characters 9 to 13; null counts as empty."""
    kept = F.coalesce(text, F.lit(""))
    for character in WHITE:
        kept = F.replace(kept, F.lit(character), F.lit(""))
    return kept


def _decimal(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(21,0)")


def _preference(chars: Column, row_id: Column) -> Column:
    """One number that grows with the code points and, at equal ones, with falling ids; a number is combined by hash."""
    rank = F.coalesce(_decimal(_TOP + 1) - row_id.cast("decimal(20,0)"), _decimal(0))
    return (chars.cast("decimal(10,0)") * _decimal(_SHIFT) + rank).cast("decimal(38,0)")


def _id_of(preference: Column) -> Column:
    rank = preference % _decimal(_SHIFT)
    return F.when(rank > 0, _decimal(_TOP + 1) - rank).cast("bigint")


def _salt(row_id: Column, salts: int) -> Column:
    """Follows from the id alone, so that a row has it again when it is read again."""
    return F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")


def exact_groups(docs: DataFrame, text: str = "text", row_id: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: text_sha256, content, keep_id, group_size, and the bits of its salts."""
    if not 0 < salts <= 64:
        raise ValueError("from 1 to 64 salts")
    rows = docs.select(
        F.col(row_id).alias("_id"),
        without_white(F.col(text)).alias("content"),
        F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("_chars"),
        _salt(F.col(row_id), salts).alias("_salt"),
    ).withColumn("text_sha256", F.sha2("content", 256))
    salted = rows.groupBy("text_sha256", "content", "_salt").agg(
        F.max(_preference(F.col("_chars"), F.col("_id"))).alias("_best"), F.count("*").alias("_rows")
    )
    whole = salted.groupBy("text_sha256", "content").agg(
        F.max("_best").alias("_best"),
        F.sum("_rows").alias("group_size"),
        F.expr("bit_or(shiftleft(1L, _salt))").alias("salt_bits"),
    )
    return whole.select("text_sha256", "content", _id_of(F.col("_best")).alias("keep_id"), "group_size", "salt_bits")


def exact_dedup(docs: DataFrame, text: str = "text", row_id: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per document: its id, keep_id, group_size, kept and text_sha256.

    Two texts under one SHA-256 digest would make the verdict ambiguous; that raises an error instead of a guess.
    """
    by_digest = (
        exact_groups(docs, text, row_id, salts)
        .groupBy("text_sha256")
        .agg(
            F.count("*").alias("_texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"),
            F.bit_or("salt_bits").alias("salt_bits"),
        )
        .select(
            "text_sha256",
            "keep_id",
            F.when(F.col("_texts") == 1, F.col("group_size"))
            .otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("bigint"))
            .alias("group_size"),
            F.explode(F.expr(f"filter(sequence(0, {salts - 1}), s -> getbit(salt_bits, s) = 1)")).alias("_salt"),
        )
    )
    members = docs.select(
        F.col(row_id).alias(row_id),
        F.sha2(without_white(F.col(text)), 256).alias("text_sha256"),
        _salt(F.col(row_id), salts).alias("_salt"),
    )
    return members.join(by_digest, ["text_sha256", "_salt"]).select(
        row_id, "keep_id", "group_size", F.col(row_id).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
