"""JSON sidecar files beside the assets."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mediacurate.functions import layout
from mediacurate.sources import files


def _read_text(path: str | None) -> str | None:
    raw = None if path is None else files.read_or_none(path)
    # Bytes that are no UTF-8 are replaced; the JSON functions then judge the body.
    return None if raw is None else raw.decode("utf-8", "replace")


@F.pandas_udf(StringType())
def _bodies(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for paths in batches:
        yield paths.map(_read_text, na_action="ignore").astype(object)


def sidecar_body(path: Column) -> Column:
    """Text of the sidecar beside ``path``; null where there is none, or the path is null.

    Each sidecar is opened by the path its asset implies: nothing is listed,
    nothing joined, and only paths and bodies pass through Python.
    """
    return _bodies(layout.with_suffix(path, ".json"))


def read_sidecars(assets: DataFrame) -> DataFrame:
    return assets.withColumn("body", sidecar_body(F.col("path")))
