import json
import threading

import pytest
from conftest import tuples

from mediacurate.operators import resume
from mediacurate.plans import jobs
from mediacurate.schemas import CAPTIONED
from mediacurate.sources import commits


def test_one_of_many_creates_the_file(tmp_path):
    path, made = str(tmp_path / "deep" / "marker"), []
    start = threading.Barrier(16)

    def attempt(i):
        start.wait()
        if commits.create_exclusively(path, b"%d" % i):
            made.append(i)

    threads = [threading.Thread(target=attempt, args=(i,)) for i in range(16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(made) == 1 and (tmp_path / "deep" / "marker").read_bytes() == b"%d" % made[0]
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["marker"]
    commits.remove(path)
    commits.remove(path)
    assert commits.create_exclusively("file://" + path, b"again")


def test_two_writers_cannot_both_start(tmp_path):
    inside, refused, start = [], [], threading.Barrier(8)
    leave = threading.Event()

    def attempt():
        start.wait()
        try:
            with jobs.single_writer(str(tmp_path)):
                inside.append(1)
                leave.wait(20)
        except RuntimeError:
            refused.append(1)
        if len(refused) == 7:
            leave.set()

    threads = [threading.Thread(target=attempt) for _ in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert (len(inside), len(refused)) == (1, 7)


def test_versions_are_made_once(spark, tmp_path, monkeypatch):
    log = commits.CommitLog(spark, str(tmp_path / "log"), "name string, n bigint")
    assert log.versions() == 0 and log.entries().count() == 0
    assert log.append([{"name": "a", "n": 1}, {"name": "b", "n": 2}]) == 0
    assert log.append([{"name": "ü", "n": None}]) == 1
    assert tuples(log.entries()) == [("a", 1, 0), ("b", 2, 0), ("ü", None, 1)]
    late = commits.CommitLog(spark, str(tmp_path / "log"), log.schema)
    monkeypatch.setattr(late, "versions", lambda: 1)  # it looked before the other wrote
    with pytest.raises(commits.Overtaken):
        late.append([{"name": "c", "n": 3}])
    assert tuples(log.entries()) == [("a", 1, 0), ("b", 2, 0), ("ü", None, 1)]


def batch_rows(spark, batches, text="c"):
    rows = [(f"k{b}-{i}", f"{text}{i}", b) for b in batches for i in range(3)]
    given = spark.createDataFrame(rows, "key string, vlm_caption string, batch_id bigint")
    missing = [f for f in resume.STORED if f.name not in given.columns]
    for field in missing:
        given = given.selectExpr("*", f"CAST(NULL AS {field.dataType.simpleString()}) AS {field.name}")
    return given.select(*resume.STORED.names)


def test_a_round_lists_its_own_directories_only(spark, tmp_path):
    path = str(tmp_path / "batches")
    resume.commit_batches(batch_rows(spark, [0, 1]), path, range(2))
    (tmp_path / "batches/batch_id=7").mkdir()
    (tmp_path / "batches/batch_id=7/part-0.parquet").write_bytes(b"left by a crash")
    round_two = resume.commit_batches(batch_rows(spark, [2, 3]), path, range(2, 4))
    assert {f.split("batch_id=")[1].split("/")[0] for f in round_two.inputFiles()} == {"2", "3"}
    stored = resume.read_committed(spark, path)
    assert tuples(stored.groupBy("batch_id").count()) == [(b, 3) for b in range(4)]
    entries = resume.commit_log(spark, path).entries()
    assert tuples(entries, "version", "batch_id", "rows", "captioned") == [(0, 0, 3, 3), (0, 1, 3, 3), (1, 2, 3, 3), (1, 3, 3, 3)]
    assert resume.next_batch_id(entries) == 4


def test_rows_written_but_not_committed_are_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "batches")
    resume.commit_batches(batch_rows(spark, [0]), path, range(1))
    with monkeypatch.context() as broken:
        broken.setattr(commits.CommitLog, "append", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            resume.commit_batches(batch_rows(spark, [1], "lost"), path, range(1, 2))
    assert tuples(resume.read_committed(spark, path), "key") == [(f"k0-{i}",) for i in range(3)]
    resume.commit_batches(batch_rows(spark, [1], "kept"), path, range(1, 2))
    assert {r.vlm_caption[:4] for r in resume.read_committed(spark, path).filter("batch_id = 1").collect()} == {"kept"}


def test_a_folder_without_a_log_is_taken_as_it_is(spark, tmp_path):
    path = str(tmp_path / "batches")
    assert resume.read_committed(spark, path).count() == 0
    resume.write_batches(batch_rows(spark, [0, 4]), path)
    assert resume.read_committed(spark, path).count() == 6
    assert resume.next_batch_id(resume.commit_log(spark, path).entries()) == 5


def test_readers_go_over_to_a_new_version_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "published")
    assert resume.read_published(spark, path).count() == 0
    stored = batch_rows(spark, [0, 1])
    manifest = resume.publish(stored, path, 3)
    assert manifest.count() == 2 and resume.read_published(spark, path).count() == 6
    complete = resume.complete_table(stored.unionByName(batch_rows(spark, [2]).limit(1)))
    with monkeypatch.context() as broken:
        broken.setattr(commits.CommitLog, "append", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            resume.publish_complete(complete, path)
    assert resume.read_published(spark, path).count() == 6  # written, but not switched to
    made = resume.publish_complete(complete, path)
    assert made.count() == 7 and set(CAPTIONED.names) <= set(made.columns)
    assert tuples(resume.read_published(spark, path), "key") == tuples(made, "key")
    assert sorted(p.name[:24] for p in tmp_path.glob("published/publish_name=b*")) == ["publish_name=batch_00001", "publish_name=batch_00002"]
    resume.publish(batch_rows(spark, [2]), path, 3)  # a later run publishes on
    assert resume.read_published(spark, path).count() == 10
    lines = (tmp_path / "published/_snapshots/000000000001.json").read_text().splitlines()
    assert json.loads(lines[0])["replaces"] is True and len(lines) == 1
