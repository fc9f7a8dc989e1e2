"""Joining assets with their metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacurate.functions import layout
from mediacurate.functions.text import has_caption, sidecar_fields
from mediacurate.operators.numbering import global_index
from mediacurate.schemas import CAPTIONED, META_RECORD, SOURCE_ROWS
from mediacurate.sources.sidecars import sidecar_body

_STRINGS = [f.name for f in META_RECORD.fields if f.dataType == T.StringType() and f.name != "key"]
_SIZES = [f.name for f in META_RECORD.fields if f.dataType == T.IntegerType()]


def project_source(source: DataFrame, *extra: str) -> DataFrame:
    """The manifest columns; the source's own key is kept as ``original_key``."""
    names = {"key": "original_key"}
    return source.select(*[F.col(n).alias(names.get(n, n)) for n in SOURCE_ROWS.names], *extra)


def row_number(file: Column, position: Column) -> Column:
    """One number for a row's place: by the number of its file, then by its position, which has 36 bits."""
    return F.shiftleft(file.cast("bigint"), 36).bitwiseOR(position)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``_no``, a number that rises with ``order``. A whole-number column is one; other orders are sorted to get one."""
    if len(order) == 1 and isinstance(rows.schema[order[0]].dataType, T.IntegralType):
        return rows.withColumn("_no", F.col(order[0]).cast("bigint"))
    names = [f"_by{i}" for i in range(len(order))]
    places = global_index(rows.select(*[F.col(c).alias(n) for c, n in zip(order, names)]).distinct(), *names, name="_no")
    alike = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(order, names)]
    return rows.join(places, alike).drop(*names)


def _highest(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """``rows`` without those that share their key with a row of a higher number.

    The highest number is found by an aggregate of numbers, and only of keys that have copies: rows of other keys meet
    none and stay where they are as long as Spark can send the few to them.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    best = rows.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.max(number).alias("_best"), F.count("*").alias("_copies"))
    alike = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    marked = rows.join(best.filter("_copies > 1"), alike, "left")
    return marked.filter(f"_copies IS NULL OR {number} <=> _best").select(*rows.columns)


def last_by_key(rows: DataFrame, keys: list[str], order: list[str], unique: bool = False) -> DataFrame:
    """One row per key, the last in ``order``. With ``unique`` no two rows of a key have the same place in it.

    Between rows of a key that share the last place a hash of the row decides, and rows alike are one.
    """
    last = _highest(_numbered(rows, order), keys, "_no").drop("_no")
    if not unique:
        others = [c for c in rows.columns if c not in keys]
        last = _highest(last.distinct().withColumn("_tie", F.xxhash64(*others)), keys, "_tie").drop("_tie")
    return last.select(*keys, *[c for c in rows.columns if c not in keys])


def caption_by_key(captions: DataFrame, order: list[str], unique: bool = False) -> DataFrame:
    """Key and caption, the last row winning, even when its caption is empty."""
    needed = captions.select("key", "caption", *[c for c in order if c not in ("key", "caption")])
    return last_by_key(needed, ["key"], order, unique).select("key", "caption")


def told_by_key(captions: DataFrame, order: list[str]) -> DataFrame:
    """Key and whether its last row has a caption; the texts end at the flag, which is the lowest bit of a number."""
    flagged = captions.select("key", has_caption(F.col("caption")).alias("_told"), *order)
    both = F.shiftleft(F.coalesce(F.col("_no"), F.lit(-(2**62))), 1).bitwiseOR(F.coalesce(F.col("_told").cast("bigint"), F.lit(0)))
    highest = _numbered(flagged, order).groupBy("key").agg(F.max(both).alias("_both"))
    return highest.select("key", (F.col("_both").bitwiseAND(1) == 1).alias("told"))


def shards_without_metadata(assets: DataFrame, shard_meta: DataFrame) -> DataFrame:
    """Shards that have assets but no metadata row; their assets fall back to sidecars."""
    return assets.select("shard").distinct().join(shard_meta.select("shard").distinct(), "shard", "left_anti")


def duplicate_keys(rows: DataFrame) -> DataFrame:
    return rows.groupBy("shard", "key").agg(F.count("*").alias("copies")).filter("copies > 1")


def _struct(value_of: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in value_of.items()) + ")"


# An absent string reads as empty; a null stays null. Sizes may be spelled as any number.
_FROM_SIDECAR = _struct(
    {n: f"CASE WHEN map_contains_key(_fields, '{n}') THEN element_at(_fields, '{n}') ELSE '' END" for n in _STRINGS}
    | {n: f"try_cast(try_cast(element_at(_fields, '{n}') AS DOUBLE) AS INT)" for n in _SIZES}
)
_EMPTY_RECORD = _struct({n: "''" for n in _STRINGS} | {n: "CAST(NULL AS INT)" for n in _SIZES})


def enrich_marked(assets: DataFrame, shard_meta: DataFrame, sidecars: DataFrame | None = None) -> DataFrame:
    """Attach to each asset (path, shard, key) its metadata record.

    The record comes as a whole from the shard metadata, else from the sidecar,
    else it is empty. ``shard_meta`` has one row per (shard, key). ``sidecars``
    (shard, key, body) is joined on the same columns, so it meets rows already
    placed; without it, the files are opened, for unmatched assets only.
    ``error`` marks rows whose sidecar is present but no JSON object.
    """
    known = shard_meta.select(
        "shard", "key", F.lit(True).alias("_meta"), F.struct(*_STRINGS, *_SIZES).alias("_record")
    )
    joined = assets.join(known, ["shard", "key"], "left")
    if sidecars is None:
        joined = joined.withColumn("body", sidecar_body(F.expr("CASE WHEN _meta IS NULL THEN path END")))
    else:
        joined = joined.join(sidecars.select("shard", "key", "body"), ["shard", "key"], "left")
    joined = joined.withColumn("_fields", F.when(F.col("_meta").isNull(), sidecar_fields(F.col("body"))))
    carried = [c for c in assets.columns if c not in META_RECORD.names]
    chosen = f"CASE WHEN _meta THEN _record WHEN _fields IS NOT NULL THEN {_FROM_SIDECAR} ELSE {_EMPTY_RECORD} END"
    bad = "CASE WHEN _meta IS NULL AND body IS NOT NULL AND _fields IS NULL THEN 'bad_sidecar' END"
    return joined.selectExpr("key", *carried, f"{chosen} AS _chosen", f"{bad} AS error").selectExpr(
        "key", *carried, *[f"_chosen.{n}" for n in _STRINGS + _SIZES], "error"
    )


def enrich(assets: DataFrame, shard_meta: DataFrame, sidecars: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their record, and the rejects. To use both, settle ``enrich_marked`` first."""
    marked = enrich_marked(assets, shard_meta, sidecars)
    rejects = marked.filter(F.col("error").isNotNull()).select("key", "path", "error")
    return marked.filter(F.col("error").isNull()).drop("error"), rejects


def captioned_projection(rows: DataFrame, *extra: str) -> DataFrame:
    """The output columns: ``caption`` becomes ``original_caption``."""
    names = {"original_caption": "caption"}
    return rows.select(
        *[F.col(names.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in CAPTIONED.fields], *extra
    )


def url_dataset(rows: DataFrame) -> DataFrame:
    """Six columns with whole-number sizes, null becoming zero."""
    sizes = [F.coalesce(F.col(n), F.lit(0)).cast("int").alias(n) for n in ("width", "height")]
    return rows.select("key", "url", "original_caption", "vlm_caption", *sizes)


def parse_paths(listing: DataFrame) -> DataFrame:
    path = F.col("path")
    return listing.select(
        "path",
        layout.stem(path).alias("stem"),
        layout.parent(path).alias("parent"),
        layout.key_shard(layout.stem(path)).alias("key_shard"),
        layout.extension(path).alias("ext"),
        layout.with_suffix(path, ".json").alias("sidecar_path"),
        (layout.parent(path) == layout.key_shard(layout.stem(path))).alias("shard_agrees"),
    )
