"""The given tables seen as a media dataset: shard rows, assets, sidecars, payloads."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from mediacurate.functions import layout
from mediacurate.operators.resume import processed_keys
from mediacurate.schemas import FAILED, SUCCESS

# Rows per shard in these views; small, so that there are many shards.
PER_SHARD = 100
# Pictures that a task holds at a time.
PICTURES = 64


# Schemas of the given tables; with them, opening a table costs no job.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def key_of(number: str) -> Column:
    return layout.key_of_index(number, PER_SHARD)


_URL = "concat('https://', source, '.example.org/', lang, '/', doc_id) AS url"
_CARRIED = ["md5(text) AS md5", "lang AS tags", "concat_ws(', ', lang, source) AS merged_tags", "doc_id"]


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source table as it is before any key is assigned."""
    return table(spark, sf_dir, "documents").selectExpr(
        _URL, "text AS caption", "concat('doc-', doc_id) AS key", *_CARRIED
    )


def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata row per document; labels decide status and missing captions."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return labelled.withColumn("key", key_of("doc_id")).selectExpr(
        "key",
        "substring(key, 1, 5) AS shard",
        "sha2(text, 256) AS sha256",
        _URL,
        "CASE WHEN quality = 0 THEN '' ELSE text END AS caption",
        "concat('doc-', doc_id) AS original_key",
        f"CASE WHEN toxic = 1 THEN '{FAILED}' ELSE '{SUCCESS}' END AS status",
        "CASE WHEN doc_id % 13 <> 0 THEN int(n_chars % 1024) END AS width",
        "int(doc_id % 768) AS height",
        "int(n_chars) AS original_width",
        "int(doc_id) AS original_height",
        *_CARRIED,
    )


def shard_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row in five has no metadata, so the fallback is exercised."""
    return shard_rows(spark, sf_dir).filter("doc_id % 5 <> 0")


def sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For the rows without metadata; some are absent, some malformed."""
    rows = shard_rows(spark, sf_dir).filter("doc_id % 5 = 0 AND doc_id % 20 <> 0")
    whole = """concat('{"key":"', key, '","caption":"', md5, '","url":"', url, '","width":',
        coalesce(string(width), 'null'), '}')"""
    return rows.selectExpr("shard", "key", f"""CASE WHEN doc_id % 15 = 0 THEN '{{"key":' ELSE {whole} END AS body""")


def asset_files(spark: SparkSession, sf_dir: str, other_dir: bool = False) -> DataFrame:
    """Paths only; every tenth document has two files. ``other_dir`` moves some out of the shard directories."""
    kinds = """CASE WHEN doc_id % 10 = 0 THEN array('webp', 'png') WHEN doc_id % 4 = 0 THEN array('jpg')
        WHEN doc_id % 4 = 1 THEN array('jpeg') WHEN doc_id % 4 = 2 THEN array('png') ELSE array('webp') END"""
    folder = "substring(key, 1, 5)"
    if other_dir:
        folder = f"CASE WHEN doc_id % 100 = 48 THEN 'tmp' ELSE {folder} END"
    rows = document_keys(spark, sf_dir).selectExpr("key", "doc_id", f"explode({kinds}) AS ext")
    return rows.selectExpr(f"concat('images/', {folder}, '/', key, '.', ext) AS path")


def page_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as payloads of the first documents' assets."""
    keyed = table(spark, sf_dir, "pages").withColumn("key", key_of("page_id"))
    return keyed.selectExpr(
        "page_id", "key", "concat('images/', substring(key, 1, 5), '/', key, '.html') AS path", "html"
    )


def document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(key_of("doc_id").alias("key"), "doc_id")


def checkpoint_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two checkpoint sources united."""
    labelled = table(spark, sf_dir, "labels").select(key_of("doc_id").alias("key"))
    captioned = document_keys(spark, sf_dir).filter(F.col("doc_id") % 7 == 0)
    return processed_keys(labelled, captioned)


@F.arrow_udf(BinaryType())
def render_picture(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Text as a grey picture 64 pixels wide, in the container and with the damage asked for."""
    import struct
    import zlib

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    def png(pixels: bytes, damage: str) -> bytes:
        lines = b"".join(b"\0" + pixels[at : at + 64] for at in range(0, len(pixels), 64))
        packed = zlib.compress(lines, 1)
        if damage == "garbled":
            packed = b"\xff" + packed[1:]
        header = struct.pack(">IIBBBBB", 64, len(pixels) // 64, 8, 0, 0, 0, 0)
        data = chunk(b"IDAT", packed)
        if damage == "bad_crc":
            data = data[:-1] + bytes([data[-1] ^ 1])
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + data + chunk(b"IEND", b"")

    def segment(code: int, body: bytes) -> bytes:
        return bytes([0xFF, code]) + struct.pack(">H", len(body) + 2) + body

    def jpeg(rows: int, extra: bytes = b"") -> bytes:
        """Even grey: every block is the code of no change and the code of no detail, one bit each."""
        one_code = bytes([1, *[0] * 15, 0])
        tables = segment(0xDB, b"\0" + bytes([1] * 64)) + segment(0xC4, b"\0" + one_code) + segment(0xC4, b"\x10" + one_code)
        frame = segment(0xC0, struct.pack(">BHHB", 8, 8 * rows, 64, 1) + b"\x01\x11\0")
        return b"\xff\xd8" + extra + tables + frame + segment(0xDA, b"\x01\x01\0\0\x3f\0") + bytes(2 * rows) + b"\xff\xd9"

    def webp(body: bytes, beyond: int) -> bytes:
        frame = b"\0\0\0\x9d\x01\x2a" + body
        whole = b"WEBPVP8 " + struct.pack("<I", len(frame)) + frame + bytes(len(frame) % 2)
        return b"RIFF" + struct.pack("<I", len(whole) + beyond) + whole

    def render(text: str, damage: str) -> bytes:
        pixels = text.encode("utf-8")
        height = -(-len(pixels) // 64) or 1
        if damage.startswith("webp"):
            return webp(struct.pack("<HH", 64, height) + pixels, 1000 if damage == "webp_cut" else 0)
        if damage.startswith("thumbnail"):  # within its second segment, with an end marker of its own
            whole = jpeg(-(-height // 8), segment(0xFE, pixels[:1000]) + segment(0xE1, b"Exif\0\0" + jpeg(1)))
            return whole[:-3] if damage == "thumbnail_cut" else whole
        whole = png(pixels.ljust(64 * height, b"\0"), damage)
        if damage == "padded":  # as devices and editors leave it
            return whole + b"\0" * (100 + len(text) % 5000)
        return whole[: len(whole) // 2] if damage == "cut" else whole

    for texts, damages in batches:
        for at in range(0, len(texts), PICTURES):
            some = zip(texts.slice(at, PICTURES).to_pylist(), damages.slice(at, PICTURES).to_pylist())
            yield pa.array([render(t, d) for t, d in some], pa.binary())


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a picture; labels decide which are cut short and which are garbled, numbers which are of another kind."""
    damage = F.when(F.col("quality") == 0, "cut").when(F.col("toxic") == 1, "garbled")
    kinds = {3: "thumbnail", 5: "thumbnail_cut", 7: "bad_crc", 8: "webp", 9: "webp_cut"}
    for rest, kind in kinds.items():
        damage = damage.when(F.col("doc_id") % 11 == rest, kind)
    damage = damage.when(F.col("doc_id") % 9 == 4, "padded").otherwise("none")
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    key = key_of("doc_id")
    return rows.select(
        key.alias("key"), layout.key_shard(key).alias("shard"), render_picture("text", damage).alias("content")
    )
