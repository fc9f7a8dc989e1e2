"""Caption and sidecar text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip takes off; all lie in the basic plane.
WHITESPACE = "".join(chr(code) for code in range(0x10000) if chr(code).isspace())


def strip(text: Column) -> Column:
    """Trim every kind of whitespace; the built-in ``trim`` takes spaces only."""
    return F.btrim(text, F.lit(WHITESPACE))


def has_caption(caption: Column) -> Column:
    """False for null and for the empty string."""
    return F.coalesce(caption != "", F.lit(False))


def sidecar_caption(body: Column) -> Column:
    """The ``caption`` field; empty when absent, null, or the JSON is malformed."""
    return F.coalesce(F.get_json_object(body, "$.caption"), F.lit(""))


def sidecar_fields(body: Column) -> Column:
    """The sidecar object as a string map; null unless the body is a JSON object."""
    parsed = F.from_json(body, "map<string,string>")
    return F.when(body.rlike(r"(?s)^\s*\{.*\}\s*$"), parsed)


def one_line(text: Column) -> Column:
    return F.regexp_replace(text, r"[\r\n\t]+", " ")


def to_int(value: Column) -> Column:
    """Integer from any numeric spelling, null when it is none."""
    return value.try_cast("double").try_cast("int")
