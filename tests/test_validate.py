from pathlib import Path

import pyarrow as pa
import pytest
from conftest import bad_checksum, in_riff, jpeg, png, put, tuples, webp, with_thumbnail
from pyspark.sql import functions as F

from mediacurate.functions import signatures
from mediacurate.operators import validate as validation
from mediacurate.plans import views
from mediacurate.session import task_count
from mediacurate.sources import assets as listing
from mediacurate.sources import containers


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("images")
    good = jpeg(spark)
    put(
        root,
        {
            "00000/good.png": png(),
            "00000/good.jpg": good,
            "00000/named.jpg": png(),
            "00000/half.png": png(damage="half"),
            "00000/half.jpg": good[: len(good) // 2],
            "00000/short.jpg": good[:30],
            "00000/flip.png": png(damage="flip"),
            "00000/no end.png": png(damage="no_end"),
            "00000/page.jpg": b"<!DOCTYPE html><html></html>",
            "00000/empty.jpg": b"",
            "00001/ok.webp": webp(),
            "00001/cut.webp": webp(claimed=5000),
            "00001/padded.jpg": good + b"\0\0\n",
            "00001/pa ss+%25.png": png(),
            "00001/notes.txt": b"x",
            "tmp/deep/er/x.jpg": good,
        },
    )
    return str(root)


WANT = {
    "good.png": (True, None),
    "good.jpg": (True, None),
    "named.jpg": (True, None),
    "half.png": (False, "truncated_png"),
    "half.jpg": (False, "truncated_jpeg"),
    "short.jpg": (False, "truncated_jpeg"),
    "flip.png": (True, None),
    "no end.png": (False, "truncated_png"),
    "page.jpg": (False, "unknown_format"),
    "empty.jpg": (False, "missing_or_empty"),
    "ok.webp": (True, None),
    "cut.webp": (False, "truncated_webp"),
    "padded.jpg": (True, None),
    "pa ss+%25.png": (True, None),
    "x.jpg": (True, None),
}


def by_name(validity):
    return {r["path"].rsplit("/", 1)[1]: (r["is_valid"], r["error"]) for r in validity.collect()}


def test_listing_sees_every_image(spark, tree):
    found = listing.list_assets(spark, tree)
    assert {r["path"].rsplit("/", 1)[1] for r in found.collect()} == set(WANT)
    assert {r["shard"] for r in found.collect()} == {"00000", "00001", "er"}
    in_shards = listing.list_assets(spark, "file:" + tree, ("jpg",), shard_dirs_only=True)
    assert in_shards.count() == 6 + 1
    assert tuples(listing.discover_shards(found)) == [("00000",), ("00001",)]


def test_a_deep_tree_is_listed_by_many_tasks(spark, tmp_path):
    names = {f"images/one/{i:02d}/{j}/x/{j}.png" for i in range(12) for j in range(2)} | {"images/top.png", "images/one/in.png"}
    put(tmp_path, {name: b"" if name.endswith("1.png") else b"x" for name in names})
    (tmp_path / "images/one/00/empty").mkdir()
    found = listing.list_files(spark, str(tmp_path / "images"))
    assert {r["path"]: r["length"] for r in found.collect()} == {str(tmp_path / n): int(not n.endswith("1.png")) for n in names}
    second = spark.createDataFrame([(str(tmp_path / f"images/one/{i:02d}"),) for i in range(12)], "path string")
    level = listing.list_level(second, 8).withColumn("task", F.spark_partition_id())
    assert level.filter("is_dir").count() == 25 and level.select("task").distinct().count() > 2
    assert listing.list_files(spark, str(tmp_path / "nowhere")).count() == 0


def test_structural(spark, tree):
    assert by_name(validation.validate(listing.list_assets(spark, tree))) == WANT


def test_content_column_gives_the_same(spark, tree):
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(tree)
    images = content.filter(~F.col("path").endswith(".txt"))
    # Files of no bytes are not returned by this source.
    want = {name: verdict for name, verdict in WANT.items() if name != "empty.jpg"}
    assert by_name(validation.check_content(images)) == want


def test_data_after_the_end_of_a_picture_is_no_damage(spark, tmp_path):
    whole = {"jpg": jpeg(spark), "png": png()}
    files = {f"images/00000/{n}_{size}.{ext}": whole[ext] + b"\1" * size for n, ext in enumerate(whole) for size in (100, 70_000)}
    cut = {f"images/00000/cut.{ext}": whole[ext][:-20] + b"\1" * 5000 for ext in whole}
    put(tmp_path, {**files, **cut})
    for level in ("structural", "decode"):
        found = listing.list_assets(spark, str(tmp_path / "images"))
        verdicts = validation.validate(found, level, directories=[str(tmp_path / "images/00000")]).collect()
        assert {Path(r["path"]).name: r["is_valid"] for r in verdicts} == {
            Path(name).name: name in files for name in [*files, *cut]
        }


def containers_of(spark):
    camera, plain, frame = with_thumbnail(jpeg(spark)), png(64, 64), (b"VP8 ", b"\0\0\0\x9d\x01\x2a" + b"x" * 41)
    truncated = {f"cut{share}.jpg": (camera[: len(camera) * share // 100], "truncated_jpeg") for share in (20, 60, 99)}
    return truncated | {
        "camera.jpg": (camera, None),
        "padded.jpg": (camera + b"\xff\xd9" + b"\1" * 70_000, None),
        "no scan.jpg": (camera[: 4 + len(camera) // 2] + b"\xff\xd9", "truncated_jpeg"),
        "segment.jpg": (camera[:2] + b"\xff\xe2\0\1" + camera[2:], "bad_segment"),
        "filled.jpg": (camera[:2] + b"\xff\xff\xff" + camera[2:], None),
        "crc.png": (bad_checksum(plain), "bad_crc"),
        "first.png": (plain[:8] + plain[33:], "bad_chunk"),
        "bare.png": (plain[:33] + plain[-12:], "truncated_png"),
        "long.png": (plain + b"IEND" * 40_000, None),
        "ok.webp": (in_riff(frame), None),
        "extended.webp": (in_riff((b"VP8X", bytes(10)), (b"VP8L", b"\x2fabc"), (b"EXIF", b"abc")), None),
        "cut.webp": (in_riff(frame)[:-9], "truncated_webp"),
        "short.webp": (in_riff(frame, claimed=30), "truncated_webp"),
        "empty.webp": (in_riff(), "truncated_webp"),
        "frame.webp": (in_riff((b"VP8 ", b"not a frame")), "bad_chunk"),
    }


def test_containers_are_walked_to_their_own_end(spark, tmp_path):
    files = containers_of(spark)
    put(tmp_path, {f"00000/{name}": body for name, (body, _) in files.items()})
    want = {name: (error is None, error) for name, (_, error) in files.items()}
    found = listing.list_assets(spark, str(tmp_path))
    assert by_name(validation.validate(found)) == want
    rows = [(f"d/{name}", bytearray(body)) for name, (body, _) in files.items()]
    assert by_name(validation.check_content(spark.createDataFrame(rows, "path string, content binary"))) == want
    decoded = by_name(validation.validate(found, "decode", directories=[str(tmp_path / "00000")]))
    assert {n for n, (ok, _) in decoded.items() if ok} == {n for n, (ok, _) in want.items() if ok}


def test_reads_are_bounded():
    class Counted(containers.Held):
        reads = 0

        def read_at(self, n, at):
            assert n <= 1 << 20
            self.reads += n
            return super().read_at(n, at)

    body = bytes(30_000_000)
    webp_file = Counted(in_riff((b"VP8 ", b"\0\0\0\x9d\x01\x2a" + body), (b"EXIF", b"x")))
    assert containers.inspect(webp_file) == ("webp", None) and webp_file.reads < 1 << 20
    segments = b"".join(b"\xff\xe2" + (60_002).to_bytes(2, "big") + body[:60_000] for _ in range(100))
    scan = b"\xff\xda\0\x02" + b"\x12\xff\0\xff\xd3" * 1_000_000
    assert containers.inspect(Counted(b"\xff\xd8" + segments + scan + b"\xff\xd9")) == ("jpeg", None)
    assert containers.inspect(Counted(b"\xff\xd8" + segments + scan)) == ("jpeg", "truncated_jpeg")


def test_files_at_the_root_and_hidden_names(spark, tmp_path):
    put(tmp_path, {"top.png": png(damage="flip"), "good.png": png(), "_hidden.png": png(damage="flip"), "00000/x.png": png(damage="flip"), "00000/deep/y.png": png()})
    root = str(tmp_path)
    validity = validation.validate(listing.list_assets(spark, root), "decode", directories=[f"{root}/00000"], root=root)
    assert by_name(validity) == {
        "top.png": (False, "undecodable"), "good.png": (True, None), "_hidden.png": (True, None), "x.png": (False, "undecodable"), "y.png": (True, None),
    }
    assert tuples(validation.not_decoded(validity)) == [("png", True, 1)]
    overlapping = validation.validate(listing.list_assets(spark, root), "decode", directories=[f"{root}/00000", f"{root}/00000/deep"], root=f"{root}/00000")
    assert overlapping.count() == 5 and by_name(overlapping)["top.png"] == (True, None) and not by_name(overlapping)["x.png"][0]
    empty = validation.validate(listing.list_assets(spark, root), "decode", root=f"{root}/nowhere")
    assert tuples(validation.not_decoded(empty)) == [("png", True, 5)]


def test_decode(spark, tree):
    found = listing.list_assets(spark, tree)
    directories = [r["path"] for r in listing.list_directory(spark, tree).filter("is_dir").collect()]
    validity = validation.validate(found, "decode", directories=directories)
    want = dict(WANT, **{"flip.png": (False, "undecodable")})
    assert by_name(validity) == want
    levels = {r["path"].rsplit("/", 1)[1]: r["check_level"] for r in validity.collect()}
    assert {n for n, level in levels.items() if level == "structural"} == {"ok.webp", "cut.webp", "empty.jpg"}


def test_decode_in_several_rounds(spark, tree, monkeypatch):
    monkeypatch.setattr(validation, "DIRECTORIES_PER_SCAN", 1)
    decoded = validation.decode_with_image_source(spark, [tree + "/00000", tree + "/00001"])
    got = {r["path"].rsplit("/", 1)[1]: r["decoded"] for r in decoded.collect()}
    assert len(got) == 9 + 4
    assert all(got[name] for name in ["good.png", "good.jpg", "named.jpg", "padded.jpg", "pa ss+%25.png"])
    assert not any(got[name] for name in ["half.png", "short.jpg", "flip.png", "page.jpg", "ok.webp"])


def test_files_at_the_root_are_scanned_some_at_a_time_whatever_their_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(validation, "FILES_PER_SCAN", 3)
    names = ["a[1].png", "b{x,y}.png", "c*.png", "c1.png", "d?.png", "e f+%25.png", "g\\h.png", "[ab].png", "é#.png", "_part=1.png"]
    put(tmp_path, {**{f"good {n}": png() for n in names}, **{n: png(damage="flip") for n in names}, "_hidden.png": png(), "x.PNG": png(), "d/y.png": png()})
    decoded = validation.decode_with_image_source(spark, [], str(tmp_path))
    assert {Path(r["path"]).name: r["decoded"] for r in decoded.collect()} == {n: False for n in names} | {f"good {n}": True for n in names}


def test_many_files_are_few_tasks(spark, tmp_path):
    files = {f"{place}{i}.png": png(4, 4, "flip" if i % 3 else None) for place in ("", "00000/", "00001/") for i in range(150)}
    put(tmp_path, files)
    names = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    spark.sparkContext.setJobGroup("few", "few")
    try:
        decoded = validation.decode_with_image_source(spark, [f"{tmp_path}/00000", f"{tmp_path}/00001"], str(tmp_path))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    seen = spark.sparkContext.statusTracker()
    stages = [seen.getStageInfo(k) for job in seen.getJobIdsForGroup("few") for k in seen.getJobInfo(job).stageIds]
    assert stages and max(stage.numTasks for stage in stages if stage) <= 2 * task_count(spark)
    assert sorted(r["decoded"] for r in decoded.collect()) == [False] * 300 + [True] * 150
    assert [spark.conf.get(name) for name in names] == before


def test_files_of_one_directory_are_walked_by_many_tasks(spark, tmp_path):
    put(tmp_path, {f"{i}.png": png(4, 4) for i in range(64)})
    validity = validation.validate(listing.list_assets(spark, str(tmp_path)), "structural")
    assert len(validity.inputFiles()) > 1 and validity.filter("is_valid").count() == 64


def test_own_decoder(spark, tree):
    def decoder(content):
        if not content.startswith(b"\x89PNG"):
            raise ValueError("only PNG here")

    validity = validation.validate(listing.list_assets(spark, tree), "decode", decoder)
    got = by_name(validity)
    assert got["good.png"] == (True, None) and got["good.jpg"] == (False, "only PNG here")


def test_format_by_content(spark, tree):
    validity = validation.validate(listing.list_assets(spark, tree))
    odd = validity.filter(signatures.format_mismatch(F.col("format"), F.col("ext")))
    assert [r["path"].rsplit("/", 1)[1] for r in odd.collect()] == ["named.jpg"]
    assert tuples(validation.misnamed(validity)) == [("jpg", "png", 1)]


def test_log_counts_and_keys(spark):
    df = spark.createDataFrame(
        [("d/a.png", "a", True, None), ("d/a.jpg", "a", False, "two\nlines\there"), ("d/b.jpg", "b", False, "x")],
        "path string, key string, is_valid boolean, error string",
    )
    assert tuples(validation.corrupt_log(df)) == [("d/a.jpg", "two lines here"), ("d/b.jpg", "x")]
    assert tuples(validation.validity_counts(df)) == [(False, 2), (True, 1)]
    assert tuples(validation.valid_keys(df)) == [("a",)]


@pytest.mark.parametrize(
    "mode,want",
    [
        ("file", ["d/a.png"]),
        ("pair", ["d/a.json", "d/a.png"]),
        ("stem", ["d/a.jpg", "d/a.json", "d/a.png", "d/a.txt"]),
    ],
)
def test_delete_plan(spark, mode, want):
    corrupt = spark.createDataFrame([("d/a.png",)], "path string")
    existing = spark.createDataFrame(
        [(p,) for p in ["d/a.png", "d/a.jpg", "d/a.json", "d/a.txt", "d/ab.json", "d/a.gif"]], "path string"
    )
    assert [r[0] for r in tuples(validation.delete_plan(corrupt, existing, mode))] == want


def test_removal(spark, tmp_path):
    put(tmp_path, {"a.jpg": b"1", "b.jpg": b"2"})
    plan = spark.createDataFrame([(str(tmp_path / "a.jpg"),), (str(tmp_path / "gone.jpg"),)], "path string")
    assert [r["removed"] for r in validation.remove_files(plan).orderBy("path").collect()] == [True, True]
    assert not (tmp_path / "a.jpg").exists() and (tmp_path / "b.jpg").exists()


def test_missing_files(spark):
    meta = spark.createDataFrame(
        [("0", k, s) for k, s in [("a", "success"), ("b", "success"), ("c", "success"), ("d", "failed_to_download")]],
        "shard string, key string, status string",
    )
    present = spark.createDataFrame([("0", "a", 5), ("0", "b", 0)], "shard string, key string, length bigint")
    assert [r[1] for r in tuples(validation.missing_files(meta, present))] == ["b", "c"]


def test_html(spark):
    pages = ["<!DOCTYPE html><p></html>\n", "<!doctype HTML></HTML>", "<html></html>", "<!DOCTYPE html><p>", "", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    errors = [r["error"] for r in validation.check_html(df).orderBy("i").collect()]
    assert errors == [None, None, "bad_head", "bad_tail", "missing_or_empty", "missing_or_empty"]


def test_pictures_are_drawn_and_walked_some_at_a_time():
    texts, damages = [f"text {i}" for i in range(200)], ["none", "cut"] * 100
    drawn = list(views.render_picture.func(iter([(pa.array(texts), pa.array(damages))])))
    assert len(drawn) > 1 and max(map(len, drawn)) <= views.PICTURES
    walked = pa.concat_arrays(list(validation._inspected.func(iter(drawn)))).to_pylist()
    assert [w["format"] for w in walked] == ["png"] * 200
    assert [w["error"] is None for w in walked] == [True, False] * 100
