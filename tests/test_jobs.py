import sys
from pathlib import Path

import pandas as pd
import pytest
from conftest import bad_checksum, in_riff, jpeg, png, put, tuples, with_thumbnail
from pyspark import cloudpickle
from pyspark.sql import functions as F

from mediacurate import __main__ as command
from mediacurate.operators import resume
from mediacurate.operators.fetch import UrlFetcher
from mediacurate.plans import jobs
from mediacurate.schemas import CAPTIONED
from mediacurate.sources.sinks import read_training_csv

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class BySize:
    """Captions a payload by its length; cannot open HTML."""

    def setup(self, options):
        self.tokens = options.max_new_tokens

    def caption(self, batch):
        if any(b.startswith(b"<!") for b in batch):
            raise ValueError("cannot identify image")
        return [f"{len(b)} bytes, {self.tokens} tokens" for b in batch]


@pytest.fixture(scope="module")
def web(spark, tmp_path_factory):
    """Twelve URLs: pictures good and bad, and two that lead nowhere."""
    root = tmp_path_factory.mktemp("web")
    good = jpeg(spark)
    put(root, {f"{i}.jpg": good for i in range(5)})
    put(root, {"5.jpg": png(), "6.jpg": good[:40], "7.jpg": b"<!DOCTYPE html></html>", "8.jpg": good, "9.jpg": good})
    captions = [f"caption {i}" for i in range(12)]
    captions[3], captions[4] = "", None
    pd.DataFrame(
        {
            "url": [f"file://{root}/{i}.jpg" for i in range(12)],
            "caption": captions,
            "key": [f"src-{i}" for i in range(12)],
            "md5": [f"m{i}" for i in range(12)],
            "tags": ["t"] * 12,
            "merged_tags": ["t, u"] * 12,
        }
    ).to_parquet(root / "source.parquet")
    return root


@pytest.fixture(scope="module")
def dataset(spark, web, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("data"))
    jobs.download(
        spark, str(web / "source.parquet"), root, UrlFetcher(), threads=4, per_shard=5, shards_per_round=2, retries=1
    )
    return root


def test_download_makes_the_tree(dataset):
    found = sorted(str(p.relative_to(dataset)) for p in Path(dataset, "images").rglob("*.jpg"))
    assert found == [f"images/0000{i // 5}/0000{i // 5}000{i % 5}.jpg" for i in range(10)]
    assert Path(dataset, "images/00001/000010000.txt").read_text() == "caption 5"


def test_download_tables(spark, dataset):
    urls = spark.read.parquet(f"{dataset}/urls.parquet")
    assert urls.columns == ["url", "caption", "original_key", "md5", "tags", "merged_tags"]
    full = spark.read.parquet(f"{dataset}/full_metadata.parquet")
    assert tuples(full.groupBy("status").count()) == [("failed_to_download", 2), ("success", 10)]
    row = full.filter("key = '000010000'").first()
    assert (row["original_key"], row["width"], row["height"], row["shard"]) == ("src-5", 8, 8, "00001")
    assert spark.read.parquet(f"{dataset}/shard_audit.parquet").filter("error IS NOT NULL").count() == 0


def test_download_manifest_and_log(spark, dataset):
    got = tuples(read_training_csv(spark, f"{dataset}/metadata.csv"))
    want = [(f"images/0000{i // 5}/0000{i // 5}000{i % 5}.jpg", f"caption {i}") for i in (0, 1, 2, 5, 8, 9)]
    assert got == want
    lines = sorted(line for p in Path(dataset, "corrupt_images.log").glob("part-*") for line in p.read_text().splitlines())
    assert [line.split("\t")[1] for line in lines] == ["truncated_jpeg", "unknown_format"]
    # Nothing is removed unless asked for.
    assert Path(dataset, "images/00001/000010002.jpg").exists()


def test_second_download_fetches_nothing(spark, web, dataset):
    class Refuses:
        def fetch(self, url, timeout):
            raise AssertionError("fetched again")

    before = tuples(spark.read.parquet(f"{dataset}/full_metadata.parquet"), "key", "status", "attempts")
    jobs.download(spark, str(web / "source.parquet"), dataset, Refuses(), per_shard=5, level="structural")
    assert tuples(spark.read.parquet(f"{dataset}/full_metadata.parquet"), "key", "status", "attempts") == before


def test_a_grown_source_is_fetched_and_keys_stay(spark, web, tmp_path):
    source, root, seen = tmp_path / "grown.parquet", str(tmp_path / "data"), []
    rows = pd.read_parquet(web / "source.parquet").iloc[:3]

    def run(frame):
        frame.to_parquet(source)
        counts = {}
        jobs.download(
            spark, str(source), root, UrlFetcher(), threads=2, per_shard=5, retries=1, level="structural",
            report=lambda name, made: counts.setdefault(name, [tuple(r) for r in made.collect()]),
        )
        full = spark.read.parquet(f"{root}/full_metadata.parquet")
        seen.append(sorted((r.key, r.original_key) for r in full.select("key", "original_key").collect()))
        return counts.get("source rows added")

    run(rows)
    more = pd.read_parquet(web / "source.parquet").iloc[[9, 0, 1, 2, 8, 1]]  # rewritten: new rows amid old ones, and a copy
    assert run(more) == [(3,)]
    assert seen[0] == [(f"00000000{i}", f"src-{i}") for i in range(3)]
    assert seen[1][:3] == seen[0] and [k for k, _ in seen[1][3:]] == ["000010000", "000010001", "000010002"]
    assert sorted(o for _, o in seen[1][3:]) == ["src-1", "src-8", "src-9"]
    assert all(Path(root, "images/00001", f"{k}.jpg").exists() for k, _ in seen[1][3:])
    assert spark.read.parquet(f"{root}/urls.parquet").count() == 6
    assert run(more) == [(0,)] and run(rows) == [(0,)] and seen[3] == seen[2] == seen[1]


def test_regenerate_without_checks_lists_every_file(spark, dataset):
    made = jobs.regenerate(spark, dataset, "none")
    assert made.count() == 8
    with pytest.raises(ValueError):
        jobs.regenerate(spark, dataset, "maybe")


def test_clean_and_rebuild(spark, web, tmp_path):
    root = str(tmp_path)
    source = str(web / "source.parquet")
    jobs.download(spark, source, root, UrlFetcher(), per_shard=5, retries=0, level="structural", validate="none")
    jobs.regenerate(spark, root, "clean", "structural")
    left = sorted(p.name for p in Path(root, "images").rglob("*.jpg"))
    assert "000010001.jpg" not in left and "000010002.jpg" not in left and len(left) == 8
    made = jobs.rebuild(spark, root, level="structural")
    got = tuples(read_training_csv(spark, f"{root}/metadata.csv"))
    assert got == tuples(made) and len(got) == 8
    assert ("images/00000/000000003.jpg", "") in got and ("images/00000/000000004.jpg", "") in got


def test_rebuild_removes_pairs_when_asked(spark, tmp_path):
    put(tmp_path, {"images/x/a.jpg": b"<!DOCTYPE html>", "images/x/a.json": b"{}", "images/x/a.txt": b"", "images/x/b.jpg": jpeg(spark)})
    put(tmp_path, {"images/x/deep/c.jpg": b"<!DOCTYPE html>"})
    made = jobs.rebuild(spark, str(tmp_path), clean=True)
    assert tuples(made) == [("images/x/b.jpg", "")]
    left = sorted(p.name for p in Path(tmp_path, "images").rglob("*.*"))
    assert left == ["a.txt", "b.jpg", "c.jpg"]


def test_cleaning_removes_what_is_cut_and_leaves_what_is_padded(spark, tmp_path):
    camera, good = with_thumbnail(jpeg(spark)), png(64, 64)
    files = {"a": camera[: len(camera) * 6 // 10], "b": camera + bytes(5000), "c": bad_checksum(good), "d": good, "e": in_riff((b"VP8L", b"\x2f1"), claimed=30)}
    put(tmp_path, {f"images/x/{name}.jpg": body for name, body in files.items()} | {"images/x/a.json": b"{}"})
    seen = {}
    made = jobs.rebuild(spark, str(tmp_path), clean=True, report=lambda name, counts: seen.update({name: tuples(counts)}))
    assert tuples(made) == [("images/x/b.jpg", ""), ("images/x/d.jpg", "")]
    assert sorted(p.name for p in (tmp_path / "images/x").iterdir()) == ["b.jpg", "d.jpg"]
    assert seen["seen by no decoder"] == [("webp", False, 1)] and seen["progress"] == [(0, 2, 3, 2, 3)]
    assert seen["named as another format"] == [("jpg", "png", 2), ("jpg", "webp", 1)]


def test_files_directly_under_the_images_are_decoded_too(spark, tmp_path):
    put(tmp_path, {"images/top.png": png(damage="flip"), "images/good.png": png(), "images/00000/x.png": png()})
    pd.DataFrame({n: ["x"] for n in ("key", "caption", "status", "url")}).to_parquet(tmp_path / "images/00000.parquet")
    seen = {}
    jobs.regenerate(spark, str(tmp_path), "clean", report=lambda name, counts: seen.update({name: tuples(counts)}))
    assert sorted(p.name for p in (tmp_path / "images").rglob("*.png")) == ["good.png", "x.png"]
    assert seen["validity"] == [(False, 1), (True, 2)] and seen["seen by no decoder"] == []


def test_caption_resume_and_publish(spark, dataset, tmp_path):
    out, pub = str(tmp_path / "run"), str(tmp_path / "pub")
    first = jobs.caption_dataset(
        spark, dataset, out, BySize(), rows_per_batch=2, max_images=5, publish_to=pub, batches_per_round=1
    )
    assert first.columns == CAPTIONED.names and first.count() == 5
    row = first.filter("key = '000000001'").first()
    assert (row["original_key"], row["original_caption"]) == ("src-1", "caption 1")
    assert row["vlm_caption"].endswith("bytes, 256 tokens")
    batches = spark.read.parquet(f"{out}/batches")
    assert tuples(batches.groupBy("batch_id").count()) == [(0, 2), (1, 2), (2, 1)]
    assert tuples(resume.read_published(spark, pub).select("key")) == tuples(first.select("key"))
    # The batches stay beside the complete table, and earlier versions can be read.
    names = F.regexp_replace("publish_name", "-.*", "")
    assert tuples(spark.read.parquet(pub).groupBy(names.alias("n")).count()) == [("batch_00001", 2), ("batch_00002", 2), ("complete", 5)]
    assert resume.read_published(spark, pub, 0).count() == 2 and resume.read_published(spark, pub, 1).count() == 4
    old = {p: p.stat().st_mtime_ns for p in Path(out, "batches").rglob("*.parquet")}

    # The same limit again finds nothing to do.
    jobs.caption_dataset(spark, dataset, out, BySize(), rows_per_batch=2, max_images=5)
    assert {p: p.stat().st_mtime_ns for p in Path(out, "batches").rglob("*.parquet")} == old

    whole = jobs.caption_dataset(spark, dataset, out, BySize(), rows_per_batch=2)
    # Ten files, one of them HTML: rejected, kept for a later run.
    assert whole.count() == 9 and whole.select("key").distinct().count() == 9
    now = {p: p.stat().st_mtime_ns for p in Path(out, "batches").rglob("*.parquet")}
    assert old.items() <= now.items()
    stored = spark.read.parquet(f"{out}/batches")
    assert tuples(stored.filter("error IS NOT NULL"), "key") == [("000010002",)]
    assert stored.agg(F.max("batch_id")).first()[0] == 5
    again = jobs.caption_dataset(spark, dataset, out, BySize(), rows_per_batch=2)
    assert again.count() == 9
    assert tuples(spark.read.parquet(f"{out}/batches").filter("batch_id = 6"), "key", "error")[0][0] == "000010002"


def test_start_over_without_resume(spark, dataset, tmp_path):
    out = str(tmp_path / "run")
    jobs.caption_dataset(spark, dataset, out, BySize(), max_images=2)
    table = jobs.caption_dataset(spark, dataset, out, BySize(), max_images=2, resume_run=False)
    assert table.count() == 2
    assert spark.read.parquet(f"{out}/batches").count() == 4


def test_bad_sidecar_is_rejected_not_captioned(spark, tmp_path):
    put(tmp_path, {"images/00000/a.jpg": jpeg(spark), "images/00000/a.json": b"[1", "images/00000/b.jpg": jpeg(spark)})
    table = jobs.caption_dataset(spark, str(tmp_path), str(tmp_path / "run"), BySize())
    assert tuples(table, "key", "url", "width") == [("b", "", None)]
    assert tuples(spark.read.parquet(str(tmp_path / "run" / "rejects")), "key", "error") == [("a", "bad_sidecar")]


def test_one_writer(tmp_path):
    with jobs.single_writer(str(tmp_path)):
        with pytest.raises(RuntimeError):
            with jobs.single_writer(str(tmp_path)):
                pass
        with jobs.single_writer(str(tmp_path), take_over=True):
            pass
    with jobs.single_writer(str(tmp_path)):
        pass


def test_command_line(spark, web, tmp_path):
    root = str(tmp_path / "data")
    command.main(
        ["download", "--source", str(web / "source.parquet"), "--output", root, "--level", "structural", "--retries", "0", "--threads", "4"]
    )
    command.main(["regenerate", "--output", root, "--validate", "--level", "structural"])
    assert read_training_csv(spark, f"{root}/metadata.csv").count() == 6
    command.main(["rebuild", "--output", root, "--level", "structural"])
    assert read_training_csv(spark, f"{root}/metadata.csv").count() == 8
    run = str(tmp_path / "run")
    command.main(
        ["caption", "--output", root, "--checkpoint-dir", run, "--captioner", "test_jobs:BySize", "--max-images", "3", "--max-tokens", "5"]
    )
    assert {r["vlm_caption"].split(", ")[1] for r in spark.read.parquet(f"{run}/all_captions").collect()} == {"5 tokens"}


def test_resources_of_captioning_tasks_can_be_named(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "caption_dataset", lambda *_, **given: seen.append(given["profile"]))
    plain = ["caption", "--output", str(tmp_path), "--checkpoint-dir", "x", "--captioner", "test_jobs:BySize"]
    command.main(plain)
    command.main([*plain, "--task-gpus", "0.5", "--task-cpus", "2"])
    asked = seen[1].taskResources
    assert seen[0] is None and (asked["gpu"].amount, asked["cpus"].amount) == (0.5, 2)


def test_failures_as_empty_captions_and_an_earlier_folder(spark, dataset, tmp_path):
    earlier, out = tmp_path / "earlier", str(tmp_path / "run")
    earlier.mkdir()
    (earlier / "checkpoint.json").write_text('{"processed_keys": ["000000001"]}')
    table = jobs.caption_dataset(spark, dataset, out, BySize(), on_error="empty", resume_from=str(earlier))
    # Ten files: one known from the earlier run, one that is HTML.
    assert table.count() == 9 and table.filter("key = '000000001'").count() == 0
    assert table.filter("vlm_caption = ''").select("key").first()[0] == "000010002"
    assert spark.read.parquet(f"{out}/batches").filter("error IS NOT NULL").count() == 0


def test_per_file_manifest_with_validation(spark, dataset):
    seen = {}
    made = jobs.regenerate(
        spark, dataset, "report", "structural", per_file=True, report=lambda name, counts: seen.update({name: counts.first()})
    )
    listed = jobs.regenerate(spark, dataset)
    assert 0 < made.count() < listed.count()
    assert seen["manifest"]["matched"] == made.count() and seen["manifest"]["corrupt"] == listed.count() - made.count()
