"""Run Spark queries beside their SQL and compare rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    return names, sorted(rows, key=repr)


def duck_rows(db, sql: str) -> tuple[list[str], list[tuple]]:
    result = db.execute(sql)
    given = [c[0] for c in result.description]
    names = sorted(given)
    order = [given.index(n) for n in names]
    rows = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    return names, sorted(rows, key=repr)


# Spark type names by the DuckDB type they must meet.
TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean", "DOUBLE": "double"}


def types_differ(df: DataFrame, db, sql: str) -> list[tuple[str, str, str]]:
    described = db.execute(f"DESCRIBE {sql}").fetchall()
    spark_types = dict(df.dtypes)
    return [(r[0], spark_types.get(r[0]), r[1]) for r in described if TYPES.get(r[1]) != spark_types.get(r[0])]
