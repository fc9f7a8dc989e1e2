"""WARC archives with revisits, segmented records and chunked payloads: writing, reading, reassembly.

A record's block is an HTTP response whose body is sent in chunks. A block of more than ``segment`` bytes is cut: the first
part is a response record with segment number 1, the others are continuation records that name it as their origin, and
the last one states the total length. Records are gzip members of their own in files of bounded size. Readers go
through files as streams; whole records are decoded where they are read, and only parts of segmented ones are shuffled,
by origin, and put together in the order of their segment numbers, one record in memory at a time.

File names carry a random part, and only files that a committed task reported are read, so tasks may run again.

Defined results: a null page counts as empty; a null id is smaller than any other; rows that repeat the id of a response are
responses; pages shorter than ``least`` bytes are always responses; an empty table gives no rows; a
record with missing, repeated or short segments, or damaged chunks, is returned with its problem and without payload;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacurate.session import scratch_path, settle_table
from mediacurate.sources.files import locate

SEGMENT = 16 << 10
CHUNK = 4 << 10
FILE_BYTES = 64 << 20
LEVEL = 4
_END = b"\r\n"
_PARTS = "origin string, segment int, last boolean, total bigint, kind string, page_id bigint, refers_to bigint, digest string, block binary"
_RECORDS = "page_id bigint, record_type string, refers_to bigint, declared string, payload_bytes bigint, payload_digest string, payload binary, problem string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ---------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(part), part) for part in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def _record(headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END * 2 + block + _END * 2


def page_records(page_id: int | None, payload: bytes, refers_to: int | None, origin: str, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response in one or more segments."""
    common = {
        "WARC-Record-ID": f"<{origin}>",
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "X-Page-ID": "" if page_id is None else str(page_id),
    }
    if refers_to is not None:
        yield _record({"WARC-Type": "revisit", **common, "X-Refers-To-Page-ID": str(refers_to)}, b"")
        return
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block = head + chunked(payload)
    if len(block) <= segment:
        yield _record({"WARC-Type": "response", **common}, block)
        return
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    yield _record({"WARC-Type": "response", **common, "WARC-Segment-Number": "1"}, parts[0])
    for number, part in enumerate(parts[1:], 2):
        headers = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"<{origin}:{number}>",
            "WARC-Segment-Origin-ID": f"<{origin}>",
            "WARC-Segment-Number": str(number),
        }
        if number == len(parts):
            headers["WARC-Segment-Total-Length"] = str(len(block))
        yield _record(headers, part)


def with_revisits(pages: DataFrame, html: str = "html", page_id: str = "page_id", least: int = 0) -> DataFrame:
    """(page_id, payload, refers_to): of equal payloads the one with the largest id is referred to by the others."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), payload.alias("payload"))
    keyed = rows.withColumn("_key", F.sha2("payload", 256))
    largest = keyed.groupBy("_key").agg(F.max("page_id").alias("_largest"))
    revisits = (F.length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("_largest"))
    return keyed.join(largest, "_key").select("page_id", "payload", F.when(revisits, F.col("_largest")).alias("refers_to"))


def write_warc(
    pages: DataFrame,
    root: str,
    html: str = "html",
    page_id: str = "page_id",
    least: int = 0,
    segment: int = SEGMENT,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the archives; the manifest has one row per file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, path, size, number = None, None, 0, 0
        task = uuid.uuid4().hex

        def done() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_arrays([pa.array([path])], names=["file"])

        for batch in batches:
            for one, body, target in zip(*(batch.column(i) for i in range(3)), strict=True):
                if stream is None:
                    path, size = f"{root}/pages-{task}-{number // 10**9:03d}-{number}.warc.gz", 0
                    system, inner = locate(path)
                    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    stream = system.open_output_stream(inner, compression=None)
                for record in page_records(one.as_py(), body.as_py(), target.as_py(), f"urn:page:{task}:{number}", segment):
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(record) + packer.flush()
                    stream.write(member)
                    size += len(member)
                number += 1
                if size >= file_bytes:
                    yield done()
                    stream = None
        if stream is not None:
            yield done()

    made = with_revisits(pages, html, page_id, least).mapInArrow(write, "file string")
    return settle_table(made, "warc-manifest")


# --- reading ---------------------------------------------------------------


def _members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one record each."""
    unpacker, parts, data = None, [], b""
    while True:
        data = data or stream.read(size)
        if not data:
            break
        unpacker = unpacker or zlib.decompressobj(31)
        parts.append(unpacker.decompress(data))
        data = b""
        if unpacker.eof:
            data = unpacker.unused_data
            yield b"".join(parts)
            unpacker, parts = None, []
    if unpacker is not None:
        raise ValueError("the archive ends inside a record")


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(_END * 2)
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    length = int(headers["content-length"])
    if not lines[0].startswith("WARC/") or len(rest) != length + 4 or rest[length:] != _END * 2:
        raise ValueError("malformed record")
    return headers, rest[:length]


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(_END, at)
        if line < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != _END:
            raise ValueError("chunk cut short")
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    head, split, body = block.partition(_END * 2)
    if not split:
        raise ValueError("response without a header")
    fields = [line.partition(b":") for line in head.lower().split(b"\r\n")[1:]]
    if any(name.strip() == b"transfer-encoding" and b"chunked" in value for name, _, value in fields):
        return dechunked(body)
    return body


def read_parts(manifest: DataFrame) -> DataFrame:
    """Every record of the files as a part: a whole record has the segment number 0."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _PARTS.split(", ")]
        kinds = (pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())

        def rows(held: list[tuple]) -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        def number(value: str | None) -> int | None:
            return int(value) if value else None

        for batch in batches:
            for file in batch.column(0).to_pylist():
                held, size = [], 0
                system, path = locate(file)
                with system.open_input_stream(path, compression=None) as stream:
                    for record in _members(stream):
                        h, block = _parsed(record)
                        total = number(h.get("warc-segment-total-length"))
                        held.append(
                            (
                                h.get("warc-segment-origin-id", h["warc-record-id"]),
                                number(h.get("warc-segment-number")) or 0,
                                total is not None,
                                total,
                                h["warc-type"],
                                number(h.get("x-page-id")),
                                number(h.get("x-refers-to-page-id")),
                                h.get("warc-payload-digest", "").removeprefix("sha1:"),
                                block,
                            )
                        )
                        size += len(block)
                        if size >= 8 << 20 or len(held) >= 5000:
                            yield rows(held)
                            held, size = [], 0
                if held:
                    yield rows(held)

    return manifest.repartition("file").mapInArrow(read, _PARTS)


class _Assembly:
    """One record under way: its parts come in the order of their numbers."""

    def __init__(self, row: dict):
        self.first, self.blocks, self.problem, self.total = row, [], None, None
        self.expected = row["segment"] and 1  # 0: a whole record

    def add(self, row: dict) -> None:
        if row["segment"] != self.expected or self.total is not None:
            self.problem = "segments missing or repeated"
        self.expected += 1
        self.blocks.append(row["block"])
        self.total = row["total"]

    def result(self) -> tuple:
        row, block, payload = self.first, b"".join(self.blocks), None
        if row["kind"] == "continuation":
            self.problem = "segments missing or repeated"
        if row["segment"] and self.problem is None and self.total != len(block):
            self.problem = "total length differs"
        if row["kind"] == "response" and self.problem is None:
            try:
                payload = payload_of(block)
                if digest_of(payload) != row["digest"]:
                    payload, self.problem = None, "digest differs"
            except ValueError as e:
                self.problem = str(e)
        found = (None, None) if payload is None else (len(payload), digest_of(payload))
        return row["page_id"], row["kind"], row["refers_to"], row["digest"], *found, payload, self.problem


def _assemble(batches: Iterator[pa.RecordBatch], keep: bool) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _RECORDS.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string())
    current, held, size = None, [], 0

    def rows() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def finish() -> None:
        nonlocal size
        made = current.result()
        size += len(made[6] or b"")
        held.append(made if keep else (*made[:6], None, made[7]))

    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
            if current is None or row["segment"] == 0 or row["origin"] != current.first["origin"]:
                if current is not None:
                    finish()
                current = _Assembly(row)
            current.add(row)
            if held and (size >= 8 << 20 or len(held) >= 5000):
                yield rows()
                held, size = [], 0
    if current is not None:
        finish()
    if held:
        yield rows()


def read_warc(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records of the archives, put together and decoded; revisits have no payload of their own."""
    parts = settle_table(read_parts(manifest), "warc-parts")

    def assemble(batches):
        return _assemble(batches, keep_payload)

    whole = parts.filter("segment = 0").mapInArrow(assemble, _RECORDS)
    cut = parts.filter("segment > 0").repartition("origin").sortWithinPartitions("origin", "segment")
    return whole.unionByName(cut.mapInArrow(assemble, _RECORDS))


def resolved(records: DataFrame) -> DataFrame:
    """Per page its payload's size and digest; a revisit takes them from the response it refers to."""
    slim = records
    sizes = (
        slim.filter("record_type = 'response' AND problem IS NULL AND page_id IS NOT NULL")
        .groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("declared"))
        .agg(F.max("payload_bytes").alias("_bytes"))
    )
    own = slim.filter("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"
    )
    again = (
        slim.filter("record_type = 'revisit'")
        .join(sizes, ["refers_to", "declared"], "left")
        .select(
            "page_id",
            F.col("_bytes").alias("payload_bytes"),
            F.col("declared").alias("payload_digest"),
            "record_type",
            "refers_to",
            F.when(F.col("_bytes").isNull(), F.lit("revisit of an unknown response")).alias("problem"),
        )
    )
    return own.unionByName(again)


def archived(spark: SparkSession, pages: DataFrame, least: int = 0, **options) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and resolve the revisits."""
    manifest = write_warc(pages, scratch_path(spark, "warc"), least=least, **options)
    return resolved(settle_table(read_warc(manifest, keep_payload=False).drop("payload"), "warc-records"))
