from pathlib import PurePosixPath

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from mediacurate.functions import layout, text

PATHS = ["a/x.tar.jpg", "a/.jpg", "a/noext", "b.c/noext", "a/trail.", "images/00001/000010002.jpeg", "solo.png", "/top.jpg", "d/é ü.webp"]


def test_path_parts_follow_pathlib(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    path = F.col("path")
    got = df.select("path", layout.stem(path), layout.parent(path), layout.with_suffix(path, ".json")).collect()
    for p, stem, parent, swapped in got:
        pure = PurePosixPath(p)
        # A trailing dot is part of the name in the reference semantics.
        want_stem = "trail." if p == "a/trail." else pure.stem
        assert (stem, parent) == (want_stem, pure.parent.name)
        want = "a/trail..json" if p == "a/trail." else str(pure.with_suffix(".json"))
        assert swapped == want


def test_roots_and_spellings_meet(spark):
    df = spark.createDataFrame(
        [("file:/d/images/a b.jpg",), ("file:///d/images/a b.jpg",), ("/d/images/a b.jpg",), ("/dd/images/a.jpg",)], "p string"
    )
    got = [r[0] for r in df.select(layout.relative_path(F.col("p"), "file:///d/")).collect()]
    assert got == ["images/a b.jpg"] * 3 + ["/dd/images/a.jpg"]
    origin = spark.createDataFrame([("file:///d/a%20b+c%25.jpg",)], "p string")
    assert origin.select(layout.decode_origin(F.col("p"))).first()[0] == "/d/a b+c%.jpg"


def test_strip_takes_what_python_takes(spark):
    cases = ["  x\t\n", " 　y\x1c", " z ", "", "\x85w\x0b"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    got = [r[1] for r in tuples(df.select("i", text.strip(F.col("c"))))]
    assert got == [c.strip() for c in cases]


@pytest.mark.parametrize(
    "body,caption,fields",
    [
        ('{"caption":"a","width":5}', "a", {"caption": "a", "width": "5"}),
        ('{"caption":null}', "", {"caption": None}),
        ('{"key":', "", None),
        ("[1,2]", "", None),
        ('"text"', "", None),
        ('{"a":"b"} rest', "", None),
        (" {} ", "", {}),
        (None, "", None),
    ],
)
def test_sidecar_bodies(spark, body, caption, fields):
    df = spark.createDataFrame([(body,)], "b string")
    row = df.select(text.sidecar_caption(F.col("b")), text.sidecar_fields(F.col("b"))).first()
    assert row[0] == caption
    assert row[1] == fields


def test_int_spellings(spark):
    df = spark.createDataFrame([("5",), ("5.0",), ("1e2",), ("x",), (None,), ("99999999999",)], "v string")
    assert [r[0] for r in df.select(text.to_int(F.col("v"))).collect()] == [5, 5, 100, None, None, None]


@pytest.mark.parametrize("per_shard", [7, 100, 10_000, 20_000])
def test_keys_of_any_index(spark, per_shard):
    numbers = [0, 1, 6, 7, 99, 100, 9_999, 10_000, 123_456, 999_999_999, 1_000_000_000, 5_000_000_000]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    got = [r[0] for r in df.select(layout.key_of_index("n", per_shard)).collect()]
    assert got == [f"{n // per_shard:05d}{n % per_shard:04d}" for n in numbers]
