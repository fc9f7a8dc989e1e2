import hashlib
import json
import sys
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import jpeg, png, put, tuples, webp
from pyspark import cloudpickle
from pyspark.sql import functions as F

from mediacurate.operators import fetch
from mediacurate.schemas import CARRIED_COLUMNS, SHARD_META
from mediacurate.sources.shards import success_captions, unify_shards


# As with any class outside an installed package, tasks get it by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Flaky:
    """Fails for URLs with ``bad``; succeeds at the third try for URLs with ``late``."""

    def __init__(self):
        self.tries = {}

    def fetch(self, url, timeout):
        self.tries[url] = self.tries.get(url, 0) + 1
        if "bad" in url or ("late" in url and self.tries[url] < 3):
            raise OSError("no answer")
        return url.encode()


def manifest(spark, urls):
    rows = [(f"00000{i:04d}", "00000", u, f"cap {i}") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "key string, shard string, url string, caption string")
    return df.withColumns({c: F.lit(c) for c in CARRIED_COLUMNS})


def test_retries_and_status(spark):
    got = fetch.fetch(manifest(spark, ["u/a", "u/bad", "u/late"]), Flaky(), threads=2)
    rows = {r["url"]: r for r in got.collect()}
    assert (rows["u/a"]["status"], rows["u/a"]["attempts"], bytes(rows["u/a"]["content"])) == ("success", 1, b"u/a")
    assert rows["u/a"]["sha256"] == hashlib.sha256(b"u/a").hexdigest()
    assert (rows["u/bad"]["status"], rows["u/bad"]["attempts"]) == ("failed_to_download", 4)
    assert "no answer" in rows["u/bad"]["error"] and rows["u/bad"]["content"] is None
    assert (rows["u/late"]["status"], rows["u/late"]["attempts"]) == ("success", 3)
    assert rows["u/a"]["original_key"] == "original_key"


def outcomes(urls, behave, threads, retries=3, pause=0.1):
    """What a sliding window gives, when each attempt began, and when each row came out."""
    began, out = {}, {}
    start = time.monotonic()

    def attempt(row):
        began.setdefault(row["url"], []).append(time.monotonic() - start)
        return {"status": "success" if behave(row["url"], len(began[row["url"]])) else "failed_to_download"}

    for row in fetch.sliding(({"url": u} for u in urls), attempt, threads, retries, pause):
        out[row["url"]] = (row["status"], row["attempts"], time.monotonic() - start)
    return began, out


def test_a_slow_request_holds_up_no_other():
    def behave(url, tried):
        time.sleep(1.5 if "slow" in url else 0.01)
        return True

    _, out = outcomes([f"http://{h}/{i}" for i, h in enumerate(["slow", *"abcdefghij" * 6])], behave, threads=3)
    slow = out.pop("http://slow/0")
    assert len(out) == 60 and max(t for *_, t in out.values()) < 1.3 < slow[2]


def test_attempts_at_a_host_are_spaced_and_others_go_on():
    began, out = outcomes(["http://bad/x", *(f"http://good/{i}" for i in range(50))], lambda url, _: "good" in url, threads=2)
    assert out["http://bad/x"][:2] == ("failed_to_download", 4)
    gaps = [b - a for a, b in zip(began["http://bad/x"], began["http://bad/x"][1:])]
    assert all(gap >= wanted for gap, wanted in zip(gaps, (0.1, 0.2, 0.4))) and gaps[2] < 2
    assert all(out[f"http://good/{i}"][:2] == ("success", 1) for i in range(50)) and out["http://good/49"][2] < 0.5
    began, out = outcomes(["u/late", "u/bad", None], lambda url, tried: url is None or "late" in url and tried == 3, threads=2, pause=60)
    assert {u: o[:2] for u, o in out.items()} == {"u/late": ("success", 3), "u/bad": ("failed_to_download", 4), None: ("success", 1)}


def test_rows_of_a_dead_host_wait_in_bounded_number():
    taken = []
    urls = (taken.append(i) or f"http://dead/{i}" for i in range(1000))
    rows = fetch.sliding(({"url": u} for u in urls), lambda row: {"status": "failed_to_download"}, 2, 0, 0.2)
    next(rows)
    assert len(taken) <= 2 + 16 * 2 + 2
    rows.close()


def test_sizes_from_headers(spark):
    assert fetch.image_size(png(12, 7)) == (12, 7)
    assert fetch.image_size(jpeg(spark, 64, 48)) == (64, 48)
    assert fetch.image_size(webp()) == (100, 50)
    assert fetch.image_size(b"\xff\xd8\xff\xe0") == (None, None)
    assert fetch.image_size(b"") == (None, None)


def test_rerun_replaces_its_shards_only(spark, tmp_path):
    out = str(tmp_path / "fetched")
    rows = manifest(spark, ["a", "b", "c"])
    both = rows.unionByName(rows.withColumns({"shard": F.lit("00001"), "key": F.concat(F.lit("00001"), F.substring("key", 6, 4))}))
    payloads, meta = fetch.write_fetched(fetch.fetch(both, Flaky()), out)
    assert (payloads.count(), meta.count()) == (6, 6)
    fetch.write_fetched(fetch.fetch(rows.limit(1), Flaky()), out)
    _, meta = fetch.read_fetched(spark, out)
    assert tuples(meta.groupBy("shard").count()) == [("00000", 1), ("00001", 3)]
    assert fetch.unfetched(both, meta).count() == 0


def test_files_with_what_belongs_to_them(spark, tmp_path):
    rows = manifest(spark, ["x", "bad"])
    out = fetch.fetch(rows, Flaky(), images_dir=str(tmp_path / "images"))
    _, meta = fetch.write_fetched(out, str(tmp_path / "shards"))
    folder = tmp_path / "images" / "00000"
    assert sorted(p.name for p in folder.iterdir()) == ["000000000.jpg", "000000000.json", "000000000.txt"]
    assert (folder / "000000000.jpg").read_bytes() == b"x"
    record = json.loads((folder / "000000000.json").read_text())
    assert record["caption"] == "cap 0" and record["width"] is None and set(record) == set(SHARD_META.names)
    assert meta.count() == 2


def test_url_fetcher_reads_file_urls(tmp_path):
    (tmp_path / "p").write_bytes(b"payload")
    assert fetch.UrlFetcher().fetch(f"file://{tmp_path}/p", 5) == b"payload"
    with pytest.raises(OSError):
        fetch.UrlFetcher().fetch(f"file://{tmp_path}/q", 5)


def shard_table(keys, width, **more):
    columns = {
        "key": keys,
        "caption": [f"c{k}" for k in keys],
        "status": ["success"] * len(keys),
        "width": width,
        **more,
    }
    return pa.table(columns)


@pytest.fixture
def shards(tmp_path):
    root = tmp_path / "images"
    put(root, {"00000/000000000.jpg": b"x"})
    pq.write_table(shard_table(["a", "b"], pa.array([1, 2], pa.int32())), root / "00000.parquet")
    pq.write_table(shard_table(["c"], pa.array([3], pa.int64())), root / "00001.parquet")
    pq.write_table(shard_table(["d", "e"], pa.array([4.0, None], pa.float64())), root / "00002.parquet")
    pq.write_table(shard_table(["f"], pa.nulls(1), note=["n"]), root / "00003.parquet")
    pq.write_table(shard_table(["z"], pa.array([9], pa.int32())).drop(["status"]), root / "00004.parquet")
    (root / "00005.parquet").write_bytes(b"PAR1 nothing PAR1")
    whole = root / "00006.parquet"
    pq.write_table(shard_table([f"g{i}" for i in range(1000)], pa.array(range(1000), pa.int32())), whole, row_group_size=100)
    spoiled = bytearray(whole.read_bytes())
    spoiled[len(spoiled) // 3 : len(spoiled) // 3 + 400] = b"\xff" * 400
    whole.write_bytes(bytes(spoiled))
    return str(root)


def test_no_shard_is_lost_silently(spark, shards):
    rows, audit = unify_shards(spark, shards)
    got = {r["key"]: r for r in rows.collect()}
    assert {k: r["width"] for k, r in got.items()} == {"a": 1, "b": 2, "c": 3, "d": 4, "e": None, "f": None, "z": 9}
    assert (got["f"]["note"], got["a"]["note"], got["a"]["shard"], got["f"]["shard"]) == ("n", None, "00000", "00003")
    assert {f.name: f.dataType for f in SHARD_META}.items() <= {f.name: f.dataType for f in rows.schema}.items()
    left_out = {r["path"].rsplit("/", 1)[1] for r in audit.filter("error IS NOT NULL").collect()}
    assert left_out == {"00005.parquet", "00006.parquet"}
    assert audit.count() == 7


def scanned_rows(spark, root):
    """Rows that all scans of files under ``root`` have given so far."""
    store, total = spark._jsparkSession.sharedState().statusStore(), 0
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = store.executionsList()
    for i in range(runs.size()):
        number = runs.apply(i).executionId()
        nodes, metrics = store.planGraph(number).allNodes(), store.executionMetrics(number)
        for j in range(nodes.size()):
            node = nodes.apply(j)
            if node.name().startswith("Scan parquet") and root[:40] in node.desc():  # long locations are cut
                own = [node.metrics().apply(k) for k in range(node.metrics().size())]
                given = [metrics.get(m.accumulatorId()) for m in own if m.name() == "number of output rows"]
                total += sum(int(g.get().replace(",", "")) for g in given if g.isDefined())
    return total


def test_each_row_group_is_read_once(spark, tmp_path):
    root = tmp_path / "once"
    root.mkdir()
    for i in range(4):
        keys = [f"{i}-{j}" for j in range(250)]
        columns = shard_table(keys, pa.array(range(250), pa.int32() if i % 2 else pa.int64()))
        pq.write_table(columns.select(columns.column_names[:: -1 if i > 1 else 1]), root / f"{i:05d}.parquet", row_group_size=50)
    rows, audit = unify_shards(spark, str(root))
    assert rows.count() == 1000 and success_captions(rows).count() == 1000
    assert rows.groupBy("shard").count().count() == 4 and audit.select("signature").distinct().count() == 2
    assert scanned_rows(spark, str(root)) == 1000
    (root / "00000.parquet").unlink()
    assert rows.count() == 1000


def test_rows_without_status_are_no_success(spark, shards):
    rows, _ = unify_shards(spark, shards)
    assert {r["key"] for r in success_captions(rows).collect()} == set("abcdef")


def test_absent_column_may_read_as_empty(spark, shards):
    rows, _ = unify_shards(spark, shards, absent="")
    got = {r["key"]: (r["url"], r["status"]) for r in rows.collect()}
    assert got["a"] == ("", "success") and got["z"] == ("", "")


def test_disputed_extra_column_becomes_text(spark, tmp_path):
    pq.write_table(shard_table(["a"], [1], note=[5]), tmp_path / "00000.parquet")
    pq.write_table(shard_table(["b"], [1], note=["x"]), tmp_path / "00001.parquet")
    rows, _ = unify_shards(spark, str(tmp_path))
    assert tuples(rows, "key", "note") == [("a", "5"), ("b", "x")]


def test_no_shards_at_all(spark, tmp_path):
    rows, audit = unify_shards(spark, str(tmp_path))
    assert rows.count() == 0 and audit.count() == 0
    assert set(SHARD_META.names) <= set(rows.columns)


def test_rows_are_not_shuffled_for_the_numbers_of_their_files(spark, tmp_path, monkeypatch):
    from mediacurate.sources import shards

    for shard in ("00000", "00001"):
        spark.createDataFrame([(f"{shard}0001", "a caption")], "key string, caption string").write.parquet(f"{tmp_path}/shard={shard}")
    plans, settle = {}, shards.settle_table

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return settle(df, label)

    monkeypatch.setattr(shards, "settle_table", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, _ = unify_shards(spark, str(tmp_path))
        assert sorted(r.key for r in rows.select("key").collect()) == ["000000001", "000010001"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning" not in plans["shard-rows"]
