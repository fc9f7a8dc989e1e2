"""Table schemas and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# Image extensions, in order of preference when a key has several files.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "webp")

# Files that belong to one stem and go with it when it is purged.
STEM_SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".txt", ".json")

# Fetch status words.
SUCCESS = "success"
FAILED = "failed_to_download"

# Columns of the source table carried through every stage.
CARRIED_COLUMNS = ("original_key", "md5", "tags", "merged_tags")

# Rows per shard; the key is a five-digit shard followed by a four-digit index.
ROWS_PER_SHARD = 10_000


def _fields(names: str, dtype: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, dtype) for name in names.split()]


SOURCE_ROWS = T.StructType(_fields("url caption key md5 tags merged_tags", T.StringType()))

SHARD_META = T.StructType(
    _fields("key caption status url", T.StringType())
    + _fields("width height original_width original_height", T.IntegerType())
    + _fields("sha256 original_key md5 tags merged_tags", T.StringType())
)

# The record looked up for an asset: everything in SHARD_META but the fetch status.
META_RECORD = T.StructType([f for f in SHARD_META.fields if f.name != "status"])

CAPTIONED = T.StructType(
    _fields("key original_key url original_caption vlm_caption", T.StringType())
    + _fields("width height original_width original_height", T.IntegerType())
    + _fields("sha256 md5 tags merged_tags", T.StringType())
)

VALIDITY = T.StructType(
    _fields("path key format", T.StringType())
    + [T.StructField("is_valid", T.BooleanType())]
    + _fields("error check_level", T.StringType())
)
