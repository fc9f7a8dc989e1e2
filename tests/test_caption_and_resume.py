import io
import json
import sys

import pandas as pd
import pytest
from conftest import tuples
from pyspark import cloudpickle
from pyspark.resource import ResourceProfileBuilder
from pyspark.sql import functions as F

from mediacurate.operators import resume
from mediacurate.operators.caption import CaptionOptions, LeadingWords, caption, load_path
from mediacurate.schemas import CAPTIONED, SHARD_META
from mediacurate.sources import checkpoints
from mediacurate.sources.checkpoints import read_checkpoint_keys
from mediacurate.streaming.ingest import once_by_key, stream_ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Recorder:
    """Says what it was given; chokes on batches holding ``boom``."""

    def setup(self, options):
        self.options = options

    def caption(self, batch):
        if any("boom" in b for b in batch):
            raise RuntimeError("model failure")
        return [f"  {b}/{len(batch)}/{self.options.max_new_tokens}/{self.options.prompt}\n" for b in batch]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(["a", "boom", "c", "d", "e"])], "i int, t string").coalesce(1)


def test_one_failure_costs_one_row(rows):
    options = CaptionOptions(prompt="P", batch_size=3, max_new_tokens=9)
    got = {r["i"]: r for r in caption(rows, Recorder(), "t", options=options).collect()}
    assert [got[i]["vlm_caption"] for i in range(5)] == ["a/1/9/P", None, "c/1/9/P", "d/2/9/P", "e/2/9/P"]
    assert got[1]["error"] == "RuntimeError: model failure" and got[0]["error"] is None


def test_failures_may_read_as_empty(rows):
    got = {r["i"]: r["vlm_caption"] for r in caption(rows, Recorder(), "t", on_error="empty").collect()}
    assert got[1] == "" and got[0].startswith("a/")


def test_unknown_policy(rows):
    with pytest.raises(ValueError):
        caption(rows, Recorder(), "t", on_error="ignore")


def test_payloads_are_loaded_in_the_task(spark, tmp_path):
    (tmp_path / "x.txt").write_text("one two three")
    paths = spark.createDataFrame([(str(tmp_path / "x.txt"),), (str(tmp_path / "gone"),)], "path string")

    def loader(path):
        return load_path(path).decode()

    got = caption(paths, LeadingWords(2), "path", loader=loader).orderBy("path").collect()
    assert got[1]["vlm_caption"] == "one two +1"
    assert got[0]["vlm_caption"] is None and "FileNotFound" in got[0]["error"]


def test_captions_are_asked_for_once(rows):
    told = caption(rows, Recorder(), "t").filter(F.col("error").isNull()).filter(F.col("vlm_caption") != "x")
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_on_a_resource_profile(rows, monkeypatch):
    """Local mode knows no resource profiles, so the profile is noted and left out of the run."""
    asked = []
    frame = type(rows)
    plain = frame.mapInPandas

    def without_profile(self, func, schema, barrier=False, profile=None):
        asked.append(profile)
        return plain(self, func, schema)

    monkeypatch.setattr(frame, "mapInPandas", without_profile)
    profile = ResourceProfileBuilder().build
    told = caption(rows, Recorder(), "t", profile=profile)
    assert asked == [profile]
    assert tuples(told) == tuples(caption(rows, Recorder(), "t"))


def stored(spark, *given):
    blank = {f.name: None for f in CAPTIONED}
    records = [{**blank, "error": None, **g} for g in given]
    return spark.createDataFrame([tuple(r.get(n) for n in resume.STORED.names) for r in records], resume.STORED)


def test_batches_replace_themselves(spark, tmp_path):
    out = str(tmp_path / "b")
    assert resume.read_batches(spark, out).count() == 0
    assert resume.next_batch_id(resume.read_batches(spark, out)) == 0
    resume.write_batches(stored(spark, {"key": "a", "batch_id": 0}, {"key": "b", "batch_id": 1}), out)
    resume.write_batches(stored(spark, {"key": "c", "batch_id": 1, "error": "bad"}), out)
    table = resume.read_batches(spark, out)
    assert tuples(table, "key", "batch_id") == [("a", 0), ("c", 1)]
    assert resume.next_batch_id(table) == 2
    assert tuples(resume.rejected(table)) == [("c", "bad", 1)]
    # A rejected key is not processed, so the next run takes it up.
    assert tuples(resume.processed_keys(resume.captioned(table))) == [("a",)]


def test_pending_and_skipped(spark):
    assets = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", "b"), ("p4", "c")], "path string, key string")
    done = spark.createDataFrame([("b",), ("z",)], "key string")
    assert tuples(resume.pending(assets, done), "path") == [("p1",), ("p4",)]
    assert resume.skip_counts(assets, done).first()[:] == (2, 2)


def test_key_tables_need_a_key(spark):
    keyed = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    other = spark.createDataFrame([("x",)], "name string")
    assert tuples(resume.processed_keys(other, keyed)) == [("a",)]
    with pytest.raises(ValueError):
        resume.processed_keys(other)


def test_publish_full_batches_without_rejects(spark, tmp_path):
    given = [{"key": f"k{i}", "batch_id": i // 2, "error": "e" if i == 1 else None} for i in range(5)]
    out = str(tmp_path / "pub")
    manifest = resume.publish(stored(spark, *given), out, 2)
    assert tuples(manifest) == [
        (0, 1, f"{out}/publish_name=batch_00001"),
        (1, 2, f"{out}/publish_name=batch_00002"),
    ]
    published = spark.read.parquet(out)
    assert tuples(published, "key", "publish_name") == [("k0", "batch_00001"), ("k2", "batch_00002"), ("k3", "batch_00002")]
    assert set(published.columns) == set(CAPTIONED.names) | {"publish_name"}


def test_complete_table_keeps_the_latest(spark):
    table = stored(
        spark,
        {"key": "a", "vlm_caption": "old", "batch_id": 0},
        {"key": "a", "vlm_caption": "new", "batch_id": 3},
        {"key": "b", "vlm_caption": None, "batch_id": 1, "error": "e"},
    )
    got = resume.complete_table(table)
    assert got.columns == CAPTIONED.names
    assert tuples(got, "key", "vlm_caption") == [("a", "new")]


def test_keys_of_earlier_runs(spark, tmp_path):
    folder = tmp_path / "checkpoints"
    folder.mkdir()
    assert read_checkpoint_keys(spark, str(folder)).count() == 0
    (folder / "checkpoint.json").write_text(json.dumps({"processed_keys": ["a", "b"], "last_index": 1}))
    pd.DataFrame({"key": ["b", "c"], "x": [1, 2]}).to_parquet(folder / "intermediate_00000001.parquet")
    pd.DataFrame({"name": ["n"]}).to_parquet(folder / "other.parquet")
    (folder / "broken.parquet").write_bytes(b"nothing")
    assert [r[0] for r in tuples(read_checkpoint_keys(spark, str(folder)))] == ["a", "b", "c"]


def test_keys_of_any_type_and_of_whole_files_only(spark, tmp_path):
    pd.DataFrame({"key": [1, 2]}).to_parquet(tmp_path / "numbers.parquet")
    pd.DataFrame({"key": ["x", None]}).to_parquet(tmp_path / "texts.parquet")
    pd.DataFrame({"key": [f"k{i}" for i in range(5000)]}).to_parquet(tmp_path / "damaged.parquet", row_group_size=500)
    body = bytearray((tmp_path / "damaged.parquet").read_bytes())
    body[len(body) // 2 : len(body) // 2 + 300] = b"\xff" * 300
    (tmp_path / "damaged.parquet").write_bytes(bytes(body))
    (tmp_path / "checkpoint.json").write_text('{"processed_keys": ["a", "b"')  # cut short
    assert [r[0] for r in tuples(read_checkpoint_keys(spark, str(tmp_path)))] == ["1", "2", "x"]


@pytest.mark.parametrize("piece", [1, 3, 64])
def test_keys_are_pulled_from_the_state_file(monkeypatch, piece):
    monkeypatch.setattr(checkpoints, "_PIECE", piece)
    keys = ["a", "ü\"\\,]", "", "x" * 200, "\u0041"]
    around = {"before": [1, [2, {"processed_keys": ["no"]}], "]"], "last_index": -12.5e3, "n": None, "o": {}}
    for state in ({**around, "processed_keys": keys}, {"processed_keys": keys, **around}, {"processed_keys": []}, around, {}, {"processed_keys": None}):
        for indent in (None, 2):
            text = json.dumps(state, indent=indent, ensure_ascii=indent is None)
            assert list(checkpoints.keys_of_state(io.BytesIO(text.encode()))) == (state.get("processed_keys") or [])
    for broken in ("", "[]", '{"processed_keys": ["a",', '{"processed_keys": [a]}', '{"x" 1}'):
        with pytest.raises(ValueError):
            list(checkpoints.keys_of_state(io.BytesIO(broken.encode())))


def arrivals(spark, keys, path):
    df = spark.createDataFrame([(k, f"cap {k}") for k in keys], "key string, caption string")
    for field in SHARD_META.fields:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    df.select(*SHARD_META.names).coalesce(1).write.mode("append").parquet(path)


def test_stream_takes_only_what_is_new(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    arrivals(spark, ["a", "b", "a"], source)
    arrivals(spark, ["b", "c"], source)
    first = stream_ingest(spark, source, target, log, files_per_trigger=1)
    assert tuples(first, "key") == [("a",), ("b",), ("c",)]
    before = {r["key"]: r["batch"] for r in first.collect()}
    arrivals(spark, ["c", "d"], source)
    second = stream_ingest(spark, source, target, log, files_per_trigger=1)
    after = {r["key"]: r["batch"] for r in second.collect()}
    assert after == {**before, "d": 2}


def test_replayed_batch_writes_its_rows_again(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    arrivals(spark, ["a", "b"], source)
    stream_ingest(spark, source, target, str(tmp_path / "log1"))
    # A fresh log stands for a commit that was lost: batch 0 runs again.
    again = stream_ingest(spark, source, target, str(tmp_path / "log2"))
    assert tuples(again, "key", "batch") == [("a", 0), ("b", 0)]


def test_once_by_key(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "key string, v int")
    assert tuples(once_by_key(batch, None), "key") == [("a",), ("b",)]
    known = spark.createDataFrame([("b",)], "key string")
    assert tuples(once_by_key(batch, known), "key") == [("a",)]


def test_stream_survives_odd_files(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    given = {"status": ["success"], "caption": ["c"]}
    pd.DataFrame({"key": ["a"], "width": [1.0], **given}).to_parquet(source / "00000.parquet")
    pd.DataFrame({"key": ["b"], "width": [2], **given}).to_parquet(source / "00001.parquet")
    (source / "00002.parquet").write_bytes(b"nothing")
    rows = stream_ingest(spark, str(source), target, str(tmp_path / "log"))
    assert tuples(rows, "key", "width") == [("a", 1), ("b", 2)]
    audit = spark.read.parquet(target + "_audit")
    assert [r["path"].rsplit("/", 1)[1] for r in audit.filter("error IS NOT NULL").collect()] == ["00002.parquet"]


def test_stream_of_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = stream_ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log"))
    assert rows.columns == [*SHARD_META.names, "batch"] and rows.count() == 0


def test_stream_first_sight_and_rows_without_a_key(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    rows = {"key": ["b", None, "a", "a", None], "caption": ["z", "n1", "second", "first", "n2"], "status": ["success"] * 5}
    pd.DataFrame(rows).to_parquet(source / "00000.parquet")
    pd.DataFrame({"key": ["b"], "caption": ["a"], "status": ["success"]}).to_parquet(source / "00001.parquet")
    taken = stream_ingest(spark, str(source), target, str(tmp_path / "log"))
    assert tuples(taken, "key", "caption") == [("a", "second"), ("b", "z")]
    noted = spark.read.parquet(target + "_audit").filter("error IS NOT NULL").collect()
    assert [(r["path"].rsplit("/", 1)[1], r["error"]) for r in noted] == [("00000.parquet", "2 rows without a key")]


class CountingCaptioner:
    """Tells how many of its captions are still held when one is asked for."""

    def setup(self, options):
        self._made = []

    def caption(self, batch):
        import weakref

        held = sum(one() is not None for one in self._made)
        made = [type("Told", (str,), {})(held) for _ in batch]
        self._made += [weakref.ref(one) for one in made]
        return made


def test_captions_leave_the_worker_while_their_batch_goes_on(spark):
    rows = spark.range(0, 2000, 1, 1).select(F.col("id").cast("string").alias("text"))
    told = caption(rows, CountingCaptioner(), "text", options=CaptionOptions(batch_size=7)).select("text", "vlm_caption")
    found = told.collect()
    assert [r.text for r in found] == [str(i) for i in range(2000)]
    assert max(int(r.vlm_caption) for r in found) < 1000
