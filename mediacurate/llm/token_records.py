"""Token ids as length-delimited binary records with a separate offset index.

A record is framed as length (8 bytes), masked checksum of the length (4), payload, masked checksum of the payload (4),
all little-endian. The checksum is CRC-32, rotated right by 15 and shifted by a constant, so that a checksum of data that
hold checksums is sound. The payload is a flag (1: the id is not null), the id (8), the number of tokens (4) and the
tokens, two bytes each for vocabularies within 65,536, else four. Beside a record file, its index has the offset of
each record (8 bytes each), for reads in any order.

Texts are ordered by range, so each task writes a stretch of the order in files of bounded size. File names carry a random
part: a task that runs again writes other files, and only the files that a committed task reported are read.

Defined results: a null or empty text gives a record of the end id alone; a null id comes before all others; rows that repeat
an id are records of their own, in the order of their texts; an empty table gives no file; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mediacurate.session import scratch_path, settle_table
from mediacurate.sources.files import locate
from mediacurate.worker import worker_table

FILE_BYTES = 128 << 20
#: Words kept by a task's memory of encodings, and the longest one kept.
KNOWN_WORDS, KNOWN_LENGTH = 1_000_000, 40
#: Words whose letters have one lower case, in composed form, and marks that no other rule of the tokenizer takes.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]{1,30})([.,;:!?)*$%&]{0,4})")
#: Fixed value: the rule by which the public vocabulary's tokenizer finds the pieces of a text.
APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MASK = 0xA282EAD8
_FRAME, _CHECK, _HEAD = "<QI", "<I", "<?qI"
_MANIFEST = "file string, stretch int, number int, records bigint, tokens bigint"
_READ = "_stretch int, _number int, _record bigint, doc_id bigint, _before bigint, n_tokens bigint, ids_crc32 bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return struct.pack(_FRAME, len(payload), masked(length)) + payload + struct.pack(_CHECK, masked(payload))


def words_apart(definition: str) -> bool:
    """Whether blanks and line feeds part the pieces that this tokenizer merges within, and are dropped.

    Known of tokenizers that split by ``APART`` alone; others take a text as a whole.
    """
    rules = json.loads(definition).get("pre_tokenizer") or {}
    first = (rules.get("pretokenizers") or [rules])[0]
    keeps = {"pattern": {"Regex": APART}, "behavior": "Removed", "invert": True}
    return first.get("type") == "Split" and keeps.items() <= first.items()


def _byte_signs() -> dict[int, str]:
    """The signs that stand for bytes in byte-level vocabularies: printable ones for themselves, others numbered on from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder(dict):
    """Encodings of whole texts by the tokenizer, remembered by word.

    Where blanks and line feeds part the pieces that the tokenizer merges within, the encodings of the stretches between
    them make up that of the text. A stretch is encoded when first met: plain letters, which no rule splits, by the
    tokenizer's model at once, all else by the whole tokenizer. ``of`` looks a word up once.
    """

    def __init__(self, definition: str, by_word: bool):
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_str(definition)
        self._model, self._signs = self._tokenizer.model, _byte_signs()
        self._by_word = by_word
        self.wide = self._tokenizer.get_vocab_size() > 65_536
        self._kind = "<u4" if self.wide else "<u2"
        self._direct = all(self._letters(w) == self._whole(w) for w in ("a", "hello", "naïve", "straße", "ÿøæ", "zwölfhundert"))

    def _whole(self, text: str) -> bytes:
        made = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(made[0].ids, self._kind).tobytes()

    def _letters(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self._signs)
        return struct.pack("<%d%s" % (len(made := self._model.tokenize(spelled)), "I" if self.wide else "H"), *[t.id for t in made])

    def __missing__(self, word: str) -> bytes:
        # Letters and the punctuation after them are merged apart, and letters in lower case.
        plain = _PLAIN.fullmatch(word)
        if plain is None or not self._direct:
            made = self._whole(word)
        elif word == (letters := plain[1].lower()):
            made = self._letters(word)
        else:
            made = self[letters] + self[plain[2]]
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = made
        return made

    def of(self, text: str, end: int) -> bytes:
        last = end.to_bytes(4 if self.wide else 2, "little")
        if not self._by_word:
            return self._whole(text) + last
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))) + last


def _encoder(definition: str, by_word: bool) -> WordEncoder:
    """One encoder per worker process, which serves many tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
    kept = worker_table("encoders")
    key = (zlib.crc32(definition.encode()), len(definition), by_word)
    if key not in kept:
        kept[key] = WordEncoder(definition, by_word)
    return kept[key]


class _Shard:
    """A record file and its index, open for writing."""

    def __init__(self, root: str, stretch: int, number: int):
        self.stretch, self.number = stretch, number
        self.file = f"{root}/records-{stretch:06d}-{number:05d}-{uuid.uuid4().hex}.rec"
        system, path = locate(self.file)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self._records, self._index = system.open_output_stream(path), system.open_output_stream(f"{path}.idx")
        self.bytes = self.records = self.tokens = 0

    def add(self, payload: bytes, tokens: int) -> None:
        framed = frame(payload)
        self._index.write(self.bytes.to_bytes(8, "little"))
        self._records.write(framed)
        self.bytes += len(framed)
        self.records += 1
        self.tokens += tokens

    def close(self) -> pa.RecordBatch:
        self._records.close()
        self._index.close()
        row = (self.file, self.stretch, self.number, self.records, self.tokens)
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        names = ["file", "stretch", "number", "records", "tokens"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)


def write_records(
    docs: DataFrame,
    tokenizer: str,
    end: int,
    root: str,
    *order: str,
    text: str = "text",
    doc_id: str = "doc_id",
    by_word: bool | None = None,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encode ``docs`` in ascending ``order`` (the id by default) into record files; the manifest, one row per file.

    ``tokenizer`` is the path of a tokenizer file on the driver; its contents travel with the tasks. ``by_word`` says whether
    words can be encoded apart; without it the definition does.
    """
    from pyspark import TaskContext

    told = Path(tokenizer).read_text()
    by_word = words_apart(told) if by_word is None else by_word
    definition = docs.sparkSession.sparkContext.broadcast(told)  # a fixed vocabulary file

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(definition.value, by_word), None
        width, stretch = 4 if encoder.wide else 2, TaskContext.get().partitionId()
        for batch in batches:
            for row_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.of(value.as_py() or "", end)
                if shard is not None and shard.bytes >= file_bytes:
                    yield shard.close()
                    shard = _Shard(root, stretch, shard.number + 1)
                shard = shard or _Shard(root, stretch, 0)
                tokens = len(ids) // width
                shard.add(struct.pack(_HEAD, row_id is not None, row_id or 0, tokens) + ids, tokens)
        if shard is not None:
            yield shard.close()

    keys = [f"_order{i}" for i in range(len(order))] or ["_id"]
    slim = docs.select(
        F.col(doc_id).cast("bigint").alias("_id"),
        F.col(text).alias("_text"),
        *(F.col(c).alias(k) for c, k in zip(order, keys, strict=False)),
    )
    placed = slim.repartitionByRange(*keys).sortWithinPartitions(*keys, "_text")
    manifest = placed.select("_id", "_text").mapInArrow(write, _MANIFEST)
    return settle_table(manifest, "records-manifest")


def offsets(file: str) -> np.ndarray:
    """Offsets of all records of a file, from its index."""
    system, path = locate(f"{file}.idx")
    with system.open_input_stream(path) as stream:
        return np.frombuffer(stream.read(), "<u8")


def _payload(stream, file: str) -> bytes | None:
    head = stream.read(struct.calcsize(_FRAME))
    if not head:
        return None
    length, check = struct.unpack(_FRAME, head)
    if masked(head[:8]) != check:
        raise ValueError(f"damaged length in {file}")
    payload = stream.read(length)
    tail = stream.read(struct.calcsize(_CHECK))
    if len(payload) < length or len(tail) < struct.calcsize(_CHECK) or struct.unpack(_CHECK, tail)[0] != masked(payload):
        raise ValueError(f"damaged record in {file}")
    return payload


def _decoded(payload: bytes) -> tuple[int | None, np.ndarray]:
    given, row_id, tokens = struct.unpack_from(_HEAD, payload)
    at = struct.calcsize(_HEAD)
    wide = len(payload) - at == 4 * tokens
    return row_id if given else None, np.frombuffer(payload, "<u4" if wide else "<u2", offset=at)


def record_at(file: str, offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its offset: id and tokens."""
    system, path = locate(file)
    with system.open_input_file(path) as handle:
        handle.seek(int(offset))
        return _decoded(_payload(handle, file))


def records(file: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """All records of a file in their order."""
    system, path = locate(file)
    with system.open_input_stream(path, buffer_size=1 << 20) as stream:
        while (payload := _payload(stream, file)) is not None:
            yield _decoded(payload)


def read_records(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per record, from the files: doc_id, start, n_tokens, ids_crc32; start counts the tokens of all records before it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_stretch", "_number", "_record", "doc_id", "_before", "n_tokens", "ids_crc32"]
        kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 5)

        def rows(held: list[tuple]) -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for one in batch.to_pylist():
                held, before, number = [], 0, 0
                for row_id, ids in records(one["file"]):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    held.append((one["stretch"], one["number"], number, row_id, before, len(ids), crc))
                    before, number = before + len(ids), number + 1
                    if len(held) >= 10_000:
                        yield rows(held)
                        held = []
                if held:
                    yield rows(held)
                if (number, before) != (one["records"], one["tokens"]):
                    raise ValueError(f"{one['file']} does not hold what its writer reported")

    # One row per file: what comes before each file.
    earlier = Window.orderBy("stretch", "number").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select(
        F.col("stretch").alias("_stretch"),
        F.col("number").alias("_number"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("_base"),
        F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("_records"),
    )
    # Few bytes, hence by number: a task for each file.
    found = manifest.repartitionByRange(max(1, manifest.count()), "file").mapInArrow(read, _READ)
    return found.join(bases, ["_stretch", "_number"]).select(
        "doc_id",
        (F.col("_base") + F.col("_before")).alias("start"),
        "n_tokens",
        "ids_crc32",
        (F.col("_records") + F.col("_record")).alias("record"),
    )


def tokenized(docs: DataFrame, tokenizer: str, end: int, *order: str, root: str | None = None, **options) -> DataFrame:
    """Write the record files of ``docs`` (to a scratch folder unless ``root`` is given) and read them back."""
    spark = docs.sparkSession
    manifest = write_records(docs, tokenizer, end, root or scratch_path(spark, "records"), *order, **options)
    return read_records(spark, manifest)
