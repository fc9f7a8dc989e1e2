"""Column expressions over asset paths ``<root>/<shard>/<key>.<ext>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mediacurate.schemas import ROWS_PER_SHARD, STEM_SUFFIXES

SUFFIX = r"(?<=.)\.[^.]+$"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    """Everything before the base name, empty when there is no slash."""
    return F.regexp_replace(F.when(F.contains(path, F.lit("/")), path).otherwise("/"), r"/[^/]*$", "")


def stem(path: Column) -> Column:
    """Base name without its last suffix; a leading dot is part of the name."""
    return F.regexp_replace(base_name(path), SUFFIX, "")


def extension(path: Column) -> Column:
    return F.regexp_extract(base_name(path), r"(?<=.)\.([^.]+)$", 1)


def parent(path: Column) -> Column:
    """Name of the directory holding the file, empty when there is none."""
    last_two = F.substring_index(path, "/", -2)
    return F.when(F.contains(path, F.lit("/")), F.substring_index(last_two, "/", 1)).otherwise("")


def base_path(path: Column) -> Column:
    """The path without its last suffix."""
    return F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", "")


def with_suffix(path: Column, suffix: str) -> Column:
    return F.concat(base_path(path), F.lit(suffix))


def stem_files(path: Column) -> Column:
    """Every file that may share the stem of ``path``."""
    base = base_path(path)
    return F.array(*[F.concat(base, F.lit(s)) for s in STEM_SUFFIXES])


def key_shard(key: Column) -> Column:
    """The first five characters; of a number of more than nine digits all but the last four."""
    long = (F.length(key) > 9) & key.rlike("^[0-9]+$")
    return F.when(long, F.left(key, F.length(key) - 4)).otherwise(F.substring(key, 1, 5))


def is_shard_name(name: Column) -> Column:
    return name.rlike("^[0-9]+$")


def normalise_root(root: str) -> str:
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    return root.rstrip("/")


def normalise_path(path: Column) -> Column:
    """``file:/x`` and ``file:///x`` both become ``/x``; other schemes stay."""
    return F.regexp_replace(path, "^file:/+", "/")


def decode_origin(origin: Column) -> Column:
    """Undo the percent-encoding the image source applies to its paths."""
    plus_kept = F.replace(origin, F.lit("+"), F.lit("%2B"))
    return normalise_path(F.url_decode(plus_kept))


def relative_path(path: Column, root: str) -> Column:
    prefix = normalise_root(root) + "/"
    whole = normalise_path(path)
    return F.when(whole.startswith(prefix), F.substring(whole, len(prefix) + 1, 2**31 - 1)).otherwise(whole)


def shard_of_index(index: str, per_shard: int = ROWS_PER_SHARD) -> Column:
    """Five digits, or more where a number needs more."""
    number = f"string({index} div {per_shard})"
    return F.expr(f"CASE WHEN length({number}) < 5 THEN lpad({number}, 5, '0') ELSE {number} END")


def key_of_index(index: str, per_shard: int = ROWS_PER_SHARD) -> Column:
    """Nine digits: shard number, then position inside the shard. Longer where a number needs more."""
    shard, place = f"({index} div {per_shard})", f"({index} % {per_shard})"
    formatted = f"format_string('%05d%04d', {shard}, {place})"
    if per_shard > 10_000:
        return F.expr(formatted)
    # Padding one number is several times cheaper than the formatter.
    padded = f"lpad(string({shard} * 10000 + {place}), 9, '0')"
    return F.expr(f"CASE WHEN {shard} < 100000 THEN {padded} ELSE {formatted} END")
