import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from mediacurate.operators import numbering
from mediacurate.operators.manifest import preferred_file
from mediacurate.sources import assets


def test_positions_equal_a_sort(spark):
    names = [f"{i:06d}" for i in range(5000)]
    shuffled = names[:]
    random.Random(3).shuffle(shuffled)
    df = spark.createDataFrame([(n,) for n in shuffled], "path string").repartition(7)
    got = tuples(numbering.global_index(df, "path"), "gidx", "path")
    assert got == sorted([(i, n) for i, n in enumerate(names)], key=repr)


def test_one_directory_may_hold_most_rows(spark):
    """A third of the rows under one shard are still spread over tasks."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "00000").otherwise(F.format_string("%05d", F.col("id") % 50)).alias("shard"), "id"
    )
    got = numbering.global_index(df, "shard", "id")
    assert got.agg(F.min("gidx"), F.max("gidx"), F.count_distinct("gidx")).first()[:] == (0, 29999, 30000)
    want = [r[0] for r in df.orderBy("shard", "id").select("id").collect()]
    assert [r[0] for r in got.orderBy("gidx").select("id").collect()] == want


def test_keys_carry_shard_and_index(spark):
    got = tuples(numbering.assign_keys(spark.range(25), "id", per_shard=10), "id", "shard", "key")
    assert (13, "00001", "000010003") in got and (0, "00000", "000000000") in got


def test_last_batch_may_be_short(spark):
    df = spark.range(120).withColumnRenamed("id", "k")
    counts = numbering.batch_counts(numbering.assign_batches(df, 50, "k"))
    assert tuples(numbering.batch_names(counts, 50)) == [
        (0, 50, "intermediate_00000049", "batch_00001"),
        (1, 50, "intermediate_00000099", "batch_00002"),
        (2, 20, "intermediate_00000120", None),
    ]


def test_batches_count_on(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    assert {r["batch_id"] for r in numbering.assign_batches(df, 2, "k", start=7).collect()} == {7, 8, 9}


def test_no_rows(spark):
    df = spark.createDataFrame([], "path string")
    assert numbering.global_index(df, "path").count() == 0


@pytest.mark.parametrize("n,want", [(None, 40), (0, 40), (7, 7), (1000, 40)])
def test_limit(spark, n, want):
    df = spark.createDataFrame([(f"p{i:02d}",) for i in range(40)], "path string").repartition(4)
    got = sorted(r[0] for r in assets.limit_assets(df, n).collect())
    assert got == [f"p{i:02d}" for i in range(want)]


def test_large_limit_by_position(spark, monkeypatch):
    monkeypatch.setattr(assets, "TOP_N_IN_ONE_TASK", 3)
    df = spark.createDataFrame([(f"p{i:02d}",) for i in range(40)], "path string").repartition(4)
    assert sorted(r[0] for r in assets.limit_assets(df, 9).collect()) == [f"p{i:02d}" for i in range(9)]


def test_progress_totals(spark):
    df = spark.range(25).select(F.col("id").alias("gidx"), (F.col("id") % 4 != 0).alias("ok"))
    assert tuples(numbering.progress(df, "ok", every=10)) == [
        (0, 7, 3, 7, 3),
        (1, 8, 2, 15, 5),
        (2, 3, 2, 18, 7),
    ]


def test_shards_of_numbers_past_nine_digits(spark):
    rows = numbering.assign_keys(spark.range(1), "id", start=1_000_000_000).unionByName(
        numbering.assign_keys(spark.range(1), "id", start=100_000_000)
    )
    assert tuples(rows, "key", "shard") == [("100000000", "10000"), ("1000000000", "100000")]
    files = rows.selectExpr("concat('images/', shard, '/', key, '.png') AS path", "key", "'png' AS ext")
    assert tuples(preferred_file(files), "path") == [("images/10000/100000000.png",), ("images/100000/1000000000.png",)]
    with pytest.raises(ValueError):
        numbering.assign_keys(spark.range(1), "id", per_shard=20_000)
