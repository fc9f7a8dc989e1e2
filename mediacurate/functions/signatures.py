"""Verdicts on payloads by column expressions, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_mismatch(found: Column, ext: Column) -> Column:
    """Whether a file's name says another format than its content."""
    named = F.when(ext.isin("jpg", "jpeg"), "jpeg").otherwise(ext)
    return F.coalesce(found != named, F.lit(False))


def html_error(html: Column) -> Column:
    """What is wrong with a web page: doctype at the start, closing tag at the end."""
    opening = F.lower(F.substring(F.ltrim(html), 1, 14))
    closing = F.lower(F.substring(F.btrim(html, F.lit(" \t\r\n")), -7, 7))
    return (
        F.when(F.coalesce(F.length(html), F.lit(0)) == 0, "missing_or_empty")
        .when(opening != "<!doctype html", "bad_head")
        .when(closing != "</html>", "bad_tail")
    )
