import csv
import io

import pandas as pd
import pytest
from conftest import tuples
from pyspark.sql import functions as F

from mediacurate.operators import manifest, metadata
from mediacurate.schemas import META_RECORD
from mediacurate.sources import assets as listing
from mediacurate.sources.sinks import read_training_csv, write_training_csv


def frame(spark, paths):
    return listing.image_assets(spark.createDataFrame([(p,) for p in paths], "path string"))


@pytest.fixture(scope="module")
def files(spark):
    return frame(
        spark,
        [
            "images/00000/000000001.png",
            "images/00000/000000001.webp",
            "images/00000/000000002.jpg",
            "images/00000/000000003.jpg",
            "images/00000/000000004.jpg",
            "images/tmp/000000005.jpg",
            "images/00001/000010000.JPG",
        ],
    )


@pytest.fixture(scope="module")
def captions(spark):
    rows = [(f"00000000{i}", c) for i, c in enumerate(["", "one", "two", None, "", "five", "six"])]
    return spark.createDataFrame(rows, "key string, caption string")


def keys(spark, *numbers):
    return spark.createDataFrame([(f"00000000{n}",) for n in numbers], "key string")


def test_last_row_of_a_key_whatever_the_order(spark):
    rows = [(k, s, n, f"{s}{n}") for k in ("a", "b", None) for s in ("x", "y", None) for n in (1, 2)]
    rows += [("hot", None, i % 7, "copy") for i in range(200)] + [("one", "x", None, None)]
    df = spark.createDataFrame(rows, "key string, s string, n int, v string").repartition(5)
    want = {k: max((r for r in rows if r[0] == k), key=lambda r: (r[1] or "", r[2] or 0)) for k in {r[0] for r in rows}}
    assert tuples(metadata.last_by_key(df, ["key"], ["s", "n"])) == sorted(want.values(), key=repr)
    by_number = metadata.last_by_key(df, ["key"], ["n"])
    assert sorted((r.key or "", r.n) for r in by_number.collect()) == [("", 2), ("a", 2), ("b", 2), ("hot", 6), ("one", None)]
    assert tuples(metadata.last_by_key(df, ["key"], ["n"])) == tuples(by_number)
    told = metadata.told_by_key(df.withColumnRenamed("v", "caption"), ["n"])
    assert {r.key: r.told for r in told.collect()} == {"a": True, "b": True, None: True, "hot": True, "one": False}


def test_validated_takes_the_preferred_file(spark, files, captions):
    got = manifest.validated(keys(spark, 1, 1, 2, 3, 4, 5, 6), captions, files)
    assert tuples(got) == [("images/00000/000000001.png", "one"), ("images/00000/000000002.jpg", "two")]


def test_validated_counters(spark, files, captions):
    got = manifest.validated_counters(keys(spark, 1, 2, 3, 4, 5, 6, 9), captions, files).first()
    assert got.asDict() == {"matched": 2, "missing_caption": 3, "no_file": 2}


def test_listing_keeps_every_file(spark, files, captions):
    got = manifest.listing(files, captions)
    assert [r[0] for r in tuples(got)] == [
        "images/00000/000000001.png",
        "images/00000/000000001.webp",
        "images/00000/000000002.jpg",
        "images/tmp/000000005.jpg",
    ]


def test_listing_leaves_out_corrupt_files(spark, files, captions):
    validity = files.select("path", (F.col("ext") != "webp").alias("is_valid"))
    assert manifest.listing(files, captions, validity).count() == 3
    got = manifest.listing_counters(files, captions, validity).first()
    assert got.asDict() == {"matched": 3, "missing_caption": 2, "corrupt": 1}


def test_last_caption_wins_even_when_empty(spark):
    rows = [("a", "old", "0", 5), ("a", "new", "1", 0), ("b", "x", "1", 1), ("b", "", "1", 2), ("c", "x", "0", 1), ("c", None, "0", 3)]
    df = spark.createDataFrame(rows, "key string, caption string, shard string, row_pos bigint")
    assert tuples(metadata.caption_by_key(df, ["shard", "row_pos"])) == [("a", "new"), ("b", ""), ("c", None)]


def test_last_by_key_and_duplicates(spark):
    rows = [("0", "a", 1, "x"), ("0", "a", 2, None), ("1", "a", 1, "z")]
    df = spark.createDataFrame(rows, "shard string, key string, n int, v string")
    assert tuples(metadata.last_by_key(df, ["shard", "key"], ["n"])) == [("0", "a", 2, None), ("1", "a", 1, "z")]
    assert tuples(metadata.duplicate_keys(df)) == [("0", "a", 2)]


def test_sidecar_manifest_keeps_empty_captions(spark, files):
    bodies = [("00000", "000000002", '{"caption":"side"}'), ("00000", "000000003", "[]"), ("00000", "000000004", '{"caption":null}')]
    sidecars = spark.createDataFrame(bodies, "shard string, key string, body string")
    got = dict(tuples(manifest.from_sidecars(files.filter("ext = 'jpg'"), sidecars)))
    assert got == {
        "images/00000/000000002.jpg": "side",
        "images/00000/000000003.jpg": "",
        "images/00000/000000004.jpg": "",
        "images/tmp/000000005.jpg": "",
    }


def test_three_modes(spark, files, captions):
    rows, counters = manifest.build_manifest("validated", files, captions, valid_keys=keys(spark, 1, 2, 3))
    assert (rows.count(), counters.first().asDict()) == (2, {"matched": 2, "missing_caption": 1, "no_file": 0})
    rows, counters = manifest.build_manifest("listing", files, captions)
    assert (rows.count(), counters.first()["matched"]) == (4, 4)
    sidecars = spark.createDataFrame([("00000", "000000002", '{"caption":"side"}')], "shard string, key string, body string")
    rows, counters = manifest.build_manifest("sidecar", files, sidecars=sidecars)
    assert counters.first().asDict() == {"matched": 6, "empty_caption": 5}
    with pytest.raises(ValueError):
        manifest.build_manifest("other", files)


def test_shards_without_metadata(spark, files):
    meta = spark.createDataFrame([("00000",)], "shard string")
    assert tuples(metadata.shards_without_metadata(files, meta)) == [("tmp",)]


def test_csv_equals_pandas(spark, tmp_path):
    prompts = ["plain", 'has "quotes", commas', "two\nlines", "  spaces  ", "back\\slash", "", 'ends\\"', "é,ü"]
    df = pd.DataFrame({"video": [f"images/{i}.jpg" for i in range(len(prompts))], "prompt": prompts})
    out = str(tmp_path / "metadata.csv")
    write_training_csv(spark.createDataFrame(df).repartition(3), out)
    parts = sorted((tmp_path / "metadata.csv").glob("part-*"))
    written = [r for p in parts for r in csv.reader(io.StringIO(p.read_text(), newline="")) if r != ["video", "prompt"]]
    assert written == df.values.tolist()
    text = "".join(p.read_text().split("\n", 1)[1] for p in parts)
    assert "video,prompt\n" + text == df.to_csv(index=False)
    assert tuples(read_training_csv(spark, out)) == sorted(map(tuple, df.values.tolist()), key=repr)


def test_empty_manifest_has_a_header(spark, tmp_path):
    write_training_csv(spark.createDataFrame([], "video string, prompt string"), str(tmp_path / "m"))
    assert "video,prompt" in "".join(p.read_text() for p in (tmp_path / "m").glob("part-*"))


def meta_row(**given):
    return tuple(given.get(f.name) for f in META_RECORD.fields)


def test_record_sources(spark):
    assets = spark.createDataFrame(
        [(f"images/0/{k}.jpg", "0", k) for k in ["meta", "nulls", "side", "bad", "list", "none"]],
        "path string, shard string, key string",
    )
    meta = spark.createDataFrame(
        [meta_row(key="meta", caption="m", url="u", width=3), meta_row(key="nulls")], META_RECORD
    ).withColumn("shard", F.lit("0"))
    sidecars = spark.createDataFrame(
        [
            ("0", "meta", '{"caption":"unused"}'),
            ("0", "side", '{"caption":"s","width":7.0,"tags":null,"more":[1]}'),
            ("0", "bad", '{"caption":'),
            ("0", "list", "[1]"),
        ],
        "shard string, key string, body string",
    )
    rows, rejects = metadata.enrich(assets, meta, sidecars)
    got = {r["key"]: r for r in rows.collect()}
    assert set(got) == {"meta", "nulls", "side", "none"}
    assert (got["meta"]["caption"], got["meta"]["width"], got["meta"]["tags"]) == ("m", 3, None)
    assert (got["nulls"]["caption"], got["nulls"]["url"]) == (None, None)
    side = got["side"]
    assert (side["caption"], side["width"], side["tags"], side["url"], side["height"]) == ("s", 7, None, "", None)
    assert (got["none"]["caption"], got["none"]["width"], got["none"]["sha256"]) == ("", None, "")
    assert tuples(rejects, "key", "error") == [("bad", "bad_sidecar"), ("list", "bad_sidecar")]


def test_sidecar_files_are_opened_for_unmatched_assets_only(spark, tmp_path):
    for name, body in {"a": "{not json", "b": '{"caption":"b"}', "c": None}.items():
        if body:
            (tmp_path / f"{name}.json").write_text(body)
    assets = spark.createDataFrame(
        [(str(tmp_path / f"{k}.jpg"), "0", k) for k in "abc"], "path string, shard string, key string"
    )
    meta = spark.createDataFrame([meta_row(key="a", caption="m")], META_RECORD).withColumn("shard", F.lit("0"))
    rows, rejects = metadata.enrich(assets, meta)
    # The malformed sidecar of a matched asset is never read.
    assert tuples(rows, "key", "caption") == [("a", "m"), ("b", "b"), ("c", "")]
    assert rejects.count() == 0


def test_url_dataset_sizes(spark):
    df = spark.createDataFrame(
        [("k", "u", "o", "v", None, 4)], "key string, url string, original_caption string, vlm_caption string, width int, height int"
    )
    assert tuples(metadata.url_dataset(df)) == [("k", "u", "o", "v", 0, 4)]
