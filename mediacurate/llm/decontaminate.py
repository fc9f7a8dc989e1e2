"""Benchmark decontamination as a prefix-filtered set join, with built-in expressions only.

A window is ``window`` consecutive words of an item, or the whole of a shorter item. A document that contains a window
contains each of its shingles (``shingle`` words, fewer for shorter items). The shingles of the benchmark are counted
in all documents, each window is represented by its rarest one (for containment of 1.0 the necessary prefix is one
token), and only documents with that token become candidates. Length and position bounds cut those whose window
would stick out of the document; what is left is compared word by word.

Defined results: null texts and texts without words have no words, windows or hits; a null id is an id like any
other; rows that repeat an id are judged each by its own text; an empty benchmark hits nothing; an empty document
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediacurate.session import settle_table

WINDOW = 13
SHINGLE = 4
#: Rows of a benchmark table that are broadcast at most (shingles with a number each: about 3 MB); more are joined by shuffle.
BROADCAST_ROWS = 100_000

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Digits, letters (A-Z in lower case) and every character from U+0080 on make words; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _NO_WORD), "")


def _shingle(words: str, position: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(F.col(words), position + i) for i in range(size)))


def _shingles(words: str, size: int) -> Column:
    """The hashed shingles of ``words`` by position."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda at: _shingle(words, at, size))


def item_windows(items: DataFrame, text: str, item_id: str, window: int) -> DataFrame:
    """One row per distinct window: its words, their number, and the ids (as strings) of the items that have it."""
    worded = items.select(F.col(item_id).cast("string").alias("_item"), words_of(F.col(text)).alias("_words"))
    length = F.least(F.size("_words"), F.lit(window))
    placed = worded.filter(F.size("_words") > 0).select(
        "_item",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - length),
                lambda at: F.slice("_words", at + 1, length),
            )
        ).alias("_words"),
    )
    # A null item id makes windows that count as hits of no named item.
    return placed.groupBy("_words").agg(F.collect_set("_item").alias("_items"))


def _small(table: DataFrame, limit: int) -> DataFrame:
    """Broadcast a settled benchmark table within ``limit`` rows; a larger one takes the shuffled join."""
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def _counted(intervals: Column) -> Column:
    """Words covered by intervals (start, length, ...) sorted by start."""
    zero = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("until"))

    def step(state: Column, one: Column) -> Column:
        until = F.greatest(state["until"], one["start"] + one["length"])
        fresh = until - F.greatest(state["until"], one["start"])
        return F.struct((state["covered"] + fresh).alias("covered"), until.alias("until"))

    return F.aggregate(intervals, zero, step, lambda state: state["covered"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    share: tuple[int, int] = (1, 20),
    broadcast_rows: int = BROADCAST_ROWS,
    carry: bool = False,
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated and the hit item ids.

    A document is contaminated when it has hits and they make up ``share`` (numerator, denominator) of its words.
    With ``carry``, the row itself is added as the struct ``_row``.
    """
    spark = docs.sparkSession
    windows = settle_table(
        item_windows(items, item_text, item_id, window).withColumn("_size", F.least(F.size("_words"), F.lit(shingle))),
        "windows",
    )
    sizes = [row[0] for row in windows.select("_size").distinct().orderBy("_size").collect()]  # at most ``shingle``
    worded = docs.select(F.col(doc_id).alias("_doc"), words_of(F.col(text)).alias("_words"))
    whole = F.struct("*") if carry else F.lit(True)
    rows = docs.select(F.col(doc_id).alias("_doc"), words_of(F.col(text)).alias("_words"), whole.alias("_row"))

    tokens = [
        windows.filter(F.col("_size") == size).select(
            "_words", "_items", F.posexplode(_shingles("_words", size)).alias("_offset", "_token")
        )
        for size in sizes
    ]
    if not tokens:
        judged = _judged(rows.withColumn("_found", F.array().cast(_FOUND)), doc_id, share)
        return judged if carry else judged.drop("_row")
    of_windows = tokens[0]
    for more in tokens[1:]:
        of_windows = of_windows.unionByName(more)
    known = _small(settle_table(of_windows.select("_token").distinct(), "tokens"), broadcast_rows)

    # Every occurrence of a benchmark shingle in the documents, found in one pass and used twice.
    met = None
    for size in sizes:
        placed = worded.select(
            "_doc", F.size("_words").alias("_n"), F.posexplode(_shingles("_words", size)).alias("_at", "_token")
        ).join(known, "_token")
        met = placed if met is None else met.unionByName(placed)
    met = settle_table(met, "occurrences")
    rarity = met.groupBy("_token").agg(F.count("*").alias("_seen"))

    rarest = (
        of_windows.join(rarity, "_token", "left")
        .groupBy("_words", "_items")
        .agg(F.min(F.struct(F.coalesce("_seen", F.lit(0)).alias("_seen"), "_token", "_offset")).alias("_first"))
        .filter("_first._seen > 0")  # a window with an absent shingle occurs nowhere
        .select("_items", F.col("_words").alias("_window"), "_first._token", "_first._offset")
    )
    start, length = F.col("_at") - F.col("_offset"), F.size("_window")
    found = (
        met.join(_small(settle_table(rarest, "prefixes"), broadcast_rows // 10), "_token")
        .filter((start >= 0) & (start + length <= F.col("_n")))
        .groupBy("_doc")
        .agg(
            F.collect_set(
                F.struct(start.alias("start"), length.alias("length"), F.col("_window").alias("words"), "_items")
            ).alias("_found")
        )
    )
    joined = rows.alias("d").join(found.alias("f"), F.col("d._doc").eqNullSafe(F.col("f._doc")), "left")
    judged = _judged(joined.select("d._doc", "_words", "_found", "_row"), doc_id, share)
    return judged if carry else judged.drop("_row")


def without_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are."""
    return contamination(docs, items, carry=True, **options).filter("NOT contaminated").select("_row.*")


_FOUND = "array<struct<start:int,length:int,words:array<string>,_items:array<string>>>"


def _judged(candidates: DataFrame, doc_id: str, share: tuple[int, int]) -> DataFrame:
    """Compare the windows that a document may contain with its words, and sum up."""
    exact = F.filter(
        F.coalesce("_found", F.array().cast(_FOUND)),
        lambda one: F.slice("_words", one["start"] + 1, one["length"]) == one["words"],
    )
    summed = (
        candidates.withColumn("_exact", F.array_sort(exact))
        .select(
            F.col("_doc").alias(doc_id),
            F.size("_words").cast("bigint").alias("n_words"),
            _counted(F.col("_exact")).cast("bigint").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.col("_exact._items")))).alias("items"),
            *(["_row"] if "_row" in candidates.columns else []),
        )
    )
    part, whole = share
    return summed.select(
        doc_id,
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * whole >= F.col("n_words") * part)).alias("contaminated"),
        "items",
        *(["_row"] if "_row" in candidates.columns else []),
    )
