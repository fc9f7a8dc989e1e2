"""Training manifests ``video, prompt`` in three modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediacurate.functions import layout
from mediacurate.functions.text import has_caption, sidecar_caption
from mediacurate.schemas import IMAGE_EXTENSIONS
from mediacurate.sources.sidecars import read_sidecars


def preferred_file(assets: DataFrame, images_dir: str = "images") -> DataFrame:
    """One path per key, by the order of the extensions, from the key's own shard directory.

    Only the rank of the extension is aggregated; the path follows from key and
    extension, so the aggregation hashes numbers and moves no paths.
    """
    ranks = F.array(*[F.lit(e) for e in IMAGE_EXTENSIONS])
    folder = F.concat(F.lit(images_dir.rstrip("/") + "/"), layout.key_shard(F.col("key")), F.lit("/"), "key", F.lit("."))
    in_place = assets.filter((F.col("path") == F.concat(folder, "ext")) & F.col("ext").isin(*IMAGE_EXTENSIONS))
    best = in_place.groupBy("key").agg(F.min(F.array_position(ranks, F.col("ext"))).alias("_rank"))
    return best.select("key", F.concat(folder, F.element_at(ranks, F.col("_rank").cast("int"))).alias("path"))


def _pair(root: str | None) -> list[Column]:
    path = F.col("path") if root is None else layout.relative_path(F.col("path"), root)
    return [path.alias("video"), F.col("caption").alias("prompt")]


def validated(
    valid_keys: DataFrame,
    captions: DataFrame,
    assets: DataFrame,
    root: str | None = None,
    images_dir: str = "images",
) -> DataFrame:
    """Per valid key with a caption: its preferred file.

    ``captions`` has one row per key. All three sides are keyed alike, so the
    aggregation that picks the file and the joins share one placement.
    """
    told = captions.filter(has_caption(F.col("caption")))
    rows = preferred_file(assets, images_dir).join(valid_keys.select("key").distinct(), "key").join(told, "key")
    return rows.select(*_pair(root))


def _told(captions: DataFrame) -> DataFrame:
    """Key and flag, of a table that has the flag ``told`` or the caption itself."""
    flag = F.col("told") if "told" in captions.columns else has_caption(F.col("caption"))
    return captions.select("key", flag.alias("_told"))


def validated_counters(
    valid_keys: DataFrame, captions: DataFrame, assets: DataFrame, images_dir: str = "images"
) -> DataFrame:
    """Matched, missing caption, and captioned without a file.

    ``captions`` has one row per key: the caption, or the flag ``told`` (``metadata.told_by_key``), which keeps
    the texts out of the shuffle that finds the last row of a key.
    """
    told = _told(captions)
    files = preferred_file(assets, images_dir).select("key", F.lit(True).alias("_file"))
    marked = (
        valid_keys.select("key")
        .distinct()
        .join(told, "key", "left")
        .join(files, "key", "left")
        .select(F.coalesce("_told", F.lit(False)).alias("told"), F.coalesce("_file", F.lit(False)).alias("file"))
    )
    return marked.agg(
        F.count_if(F.col("told") & F.col("file")).alias("matched"),
        F.count_if(~F.col("told")).alias("missing_caption"),
        F.count_if(F.col("told") & ~F.col("file")).alias("no_file"),
    )


def listing(assets: DataFrame, captions: DataFrame, validity: DataFrame | None = None, root: str | None = None) -> DataFrame:
    """Per file whose key has a caption; with ``validity``, only files that passed."""
    kept = assets
    if validity is not None:
        kept = kept.join(validity.filter("is_valid").select("path"), "path", "left_semi")
    told = captions.filter(has_caption(F.col("caption")))
    rows = kept.select("path", "key").join(told.select("key", "caption"), "key")
    return rows.select(*_pair(root))


def listing_counters(assets: DataFrame, captions: DataFrame, validity: DataFrame | None = None) -> DataFrame:
    """Per file: matched, missing caption, corrupt. ``captions`` as for ``validated_counters``."""
    marked = assets.select("path", "key").join(_told(captions), "key", "left")
    if validity is None:
        marked = marked.withColumn("_valid", F.lit(True))
    else:
        marked = marked.join(validity.select("path", F.col("is_valid").alias("_valid")), "path", "left")
    told_flag = F.coalesce(F.col("_told"), F.lit(False))
    valid_flag = F.coalesce(F.col("_valid"), F.lit(False))
    return marked.agg(
        F.count_if(told_flag & valid_flag).alias("matched"),
        F.count_if(~told_flag).alias("missing_caption"),
        F.count_if(told_flag & ~valid_flag).alias("corrupt"),
    )


def from_sidecars(assets: DataFrame, sidecars: DataFrame | None = None, root: str | None = None) -> DataFrame:
    """Per file, with the sidecar's caption; empty captions are kept.

    Without a table of ``sidecars`` (shard, key, body) the files are opened.
    """
    if sidecars is None:
        rows = read_sidecars(assets)
    else:
        rows = assets.join(sidecars.select("shard", "key", "body"), ["shard", "key"], "left")
    rows = rows.select("path", sidecar_caption(F.col("body")).alias("caption"))
    return rows.select(*_pair(root))


def build_manifest(
    mode: str,
    assets: DataFrame,
    captions: DataFrame | None = None,
    valid_keys: DataFrame | None = None,
    validity: DataFrame | None = None,
    sidecars: DataFrame | None = None,
    root: str | None = None,
    images_dir: str = "images",
    told: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows and counters in one of three modes: ``validated``, ``listing`` or ``sidecar``.

    ``told`` (key and flag) serves the counters in place of ``captions``.
    """
    counted = captions if told is None else told
    if mode == "validated":
        rows = validated(valid_keys, captions, assets, root, images_dir)
        return rows, validated_counters(valid_keys, counted, assets, images_dir)
    if mode == "listing":
        return listing(assets, captions, validity, root), listing_counters(assets, counted, validity)
    if mode == "sidecar":
        rows = from_sidecars(assets, sidecars, root)
        return rows, rows.agg(F.count("*").alias("matched"), F.count_if(F.col("prompt") == "").alias("empty_caption"))
    raise ValueError(f"unknown mode {mode!r}")
