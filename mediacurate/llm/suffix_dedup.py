"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A string of ``LENGTH`` bytes (a window) is removed where it also starts in a document with a smaller id. Windows that are
equal share the least hash of their grams, so this hash deals them out: stretches of neighbouring windows with one least hash travel
as one piece of text. The steps:

1. documents are packed into blocks of text, written once; a block reports the least hashes of its stretches;
2. a bucket of hashes tells which of them more than one block has;
3. a block settles the windows that repeat within it, and sends one piece of text for each stretch left whose
   hash other blocks have too: equal windows of a block are sent once, whatever their number;
4. a bucket sorts the suffixes at the windows it was sent, one bucket at a time, and reports those that start in a
   smaller document elsewhere;
5. a block joins what steps 3 and 4 found, and cuts the bytes out of its documents.

Windows are compared exactly. Suffixes are sorted by their leading and trailing sixteen bytes; long ties are resolved by ranks: of
the places in a difference cover modulo sixteen, precomputed over the bytes between. For any two places the
cover has a common distance below sixteen at which both are in it, so equal ranks there, with equal ends, mean equal windows.
Ranks are kept for five of sixteen places, so a bucket needs memory for its own text and no more.

Defined results: a null or empty text has no bytes and loses none; a null id is larger than any other; rows that repeat
an id do not count as repeats of each other; texts shorter than a window are kept whole; an empty table gives no rows;
other columns are ignored. A single text is held in memory whole.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacurate.session import scratch_path, settle_table

LENGTH = 50
GRAM = 20
BLOCK_BYTES = 3 << 20
#: Hashes and windows that a bucket takes on average.
BUCKET_HASHES, BUCKET_WINDOWS = 2_000_000, 500_000
PERIOD = 16
COVER = (0, 1, 2, 5, 8)  # every distance modulo 16 is a difference of two of these
_LAST = 2**63 - 1

_MEMBER = np.isin(np.arange(PERIOD), COVER)
#: For the places of two suffixes modulo the period: the least distance at which both are in the cover.
_DISTANCE = np.array(
    [[next(d for d in range(PERIOD) if _MEMBER[(a + d) % PERIOD] and _MEMBER[(b + d) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)]
)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# --- arrays of one stretch of bytes -------------------------------------------


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers that compare like the bytes."""
    w = text.astype(np.uint64)
    for width in (1, 2, 4):
        w = (w[:-width] << np.uint64(8 * width)) | w[width:]
    return w


def _mixed(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        h = (h ^ part) * _M2
        h ^= h >> np.uint64(31)
    return h


def least_hashes(text: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For each window of ``text``, the least hash of the grams in it."""
    n = len(text) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    w = _words(text)  # gram of 20 bytes: words at 0, 8 and 12
    m = len(text) - gram + 1
    h = (w[:m] * _M1) ^ ((w[8 : 8 + m] + _M3) * _M2)
    h ^= h >> np.uint64(29)
    h = (h + w[gram - 8 : gram - 8 + m]) * _M3
    h ^= h >> np.uint64(32)
    span, width = length - gram + 1, 1
    while 2 * width <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    rest = span - width
    return np.minimum(h[:n], h[rest : rest + n])


def _cover_ranks(words: np.ndarray, reach: int, starts: np.ndarray) -> np.ndarray:
    """Ranks of the strings of ``reach`` bytes at those places of the cover that follow ``starts`` within a period."""
    ranks = np.full(len(words) + 8, -1, np.int32)
    near = np.bincount(starts, minlength=len(ranks) + PERIOD)
    near[PERIOD:] -= near[:-PERIOD].copy()  # one where a start is, one less a period later
    places = np.flatnonzero((np.cumsum(near[: len(ranks)]) > 0) & np.resize(_MEMBER, len(ranks)))
    if not len(places):
        return ranks
    offsets = [*range(0, reach - 8, 8), reach - 8]
    keys = [words[places + o] for o in offsets]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    ranks[places[order]] = np.cumsum(new)
    return ranks


def sorted_classes(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each window (its place in ``text``), the first of the windows equal to it, as an index of ``starts``.

    ``starts`` keep their order among equals, so the first is the one that comes first in ``starts``.
    """
    leader = np.arange(len(starts))
    if len(starts) < 2:
        return leader
    words = _words(text)
    ends = [words[starts], words[starts + 8], words[starts + length - 16], words[starts + length - 8]]
    mixed = _mixed(*ends[1:])
    order = np.lexsort((mixed, ends[0]))  # stable
    tied = (ends[0][order][1:] == ends[0][order][:-1]) & (mixed[order][1:] == mixed[order][:-1])
    group = np.concatenate([[0], np.cumsum(~tied)])
    sizes = np.bincount(group)
    order, group = order[sizes[group] > 1], group[sizes[group] > 1]
    if not len(order):
        return leader
    ranks = _cover_ranks(words, length - PERIOD, starts[order])
    residue = starts % PERIOD
    while len(order):
        first = np.concatenate([[True], group[1:] != group[:-1]])
        head = order[first][np.cumsum(first) - 1]
        same = np.ones(len(order), bool)
        for end in ends:
            same &= end[order] == end[head]
        distance = _DISTANCE[residue[order], residue[head]]
        same &= ranks[starts[order] + distance] == ranks[starts[head] + distance]
        leader[order[same]] = head[same]
        order, group = order[~same], group[~same]
    return leader


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _gathered(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces of ``text`` one after the other."""
    offsets = np.cumsum(lengths) - lengths
    return text[np.arange(lengths.sum()) + np.repeat(starts - offsets, lengths)]


# --- blocks ------------------------------------------------------------------------

_BLOCK = "block bigint, ids binary, absent binary, lengths binary, body binary"


_CODEC = "zstd"


def _packed(data: bytes) -> bytes:
    return pa.Codec(_CODEC, compression_level=3).compress(data, asbytes=True)


def _unpacked(data: bytes, size: int) -> bytes:
    return pa.Codec(_CODEC).decompress(data, int(size), asbytes=True) if size else b""


def _row(names: list[str], kinds: list, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)


def blocks_of(docs: DataFrame, text: str, doc_id: str, block_bytes: int) -> DataFrame:
    """Documents packed as they come: one row per ``block_bytes`` of text, or per longer text."""
    from pyspark import TaskContext

    names = [f.split()[0] for f in _BLOCK.split(", ")]
    kinds = [pa.int64()] + [pa.binary()] * 4

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bodies, size, number = [], [], 0, TaskContext.get().partitionId() << 32

        def done() -> pa.RecordBatch:
            numbers = np.array([_LAST if i is None else i for i in ids], np.int64)
            absent = np.array([i is None for i in ids])
            lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
            body = _packed(b"".join(bodies))
            return _row(names, kinds, number, numbers.tobytes(), absent.tobytes(), lengths.tobytes(), body)

        for batch in batches:
            for row_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = (value.as_py() or "").encode()
                if ids and size + len(body) > block_bytes:
                    yield done()
                    ids, bodies, size, number = [], [], 0, number + 1
                ids.append(row_id)
                bodies.append(body)
                size += len(body)
        if ids:
            yield done()

    slim = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return slim.mapInArrow(pack, _BLOCK)


class _Block:
    """A block unpacked: its text, and for each window that lies in one document its least hash."""

    def __init__(self, row: dict, hashes: bool = True):
        self.number = row["block"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.absent = np.frombuffer(row["absent"], bool)
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.body = _unpacked(row["body"], self.lengths.sum())
        self.text = np.frombuffer(self.body, np.uint8)
        self.ends = np.cumsum(self.lengths)
        if not hashes:
            return
        self.least = least_hashes(self.text)
        n = len(self.least)
        # Windows that would cross the end of a document count for nothing.
        inside = np.ones(len(self.text), bool)
        last = np.maximum(self.ends - LENGTH + 1, self.ends - self.lengths)
        inside[_windows(last, self.ends)] = False
        # Stretches: neighbouring windows of one document with one least hash.
        new = np.ones(n + LENGTH, bool)
        np.not_equal(self.least[1:], self.least[:-1], out=new[1:n]) if n else None
        for bound in (last, self.ends):
            new[bound[bound < n]] = True
        starts = np.flatnonzero(new[:n])
        stops = np.append(starts[1:], n)
        kept = inside[starts]
        self.starts, self.stops = starts[kept], stops[kept]
        self.stretch = self.least[self.starts]

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right")

    def ids_at(self, places: np.ndarray) -> np.ndarray:
        return self.ids[self.doc_of(places)]


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that one block is unpacked at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def _dealt(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes * _M1) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


_LOW = np.uint64(2**48 - 1)


def _shortened(hashes: np.ndarray) -> bytes:
    """Six bytes of each hash: they choose candidates only, and the bucket tells more bits apart."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _lengthened(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in ``ordered``; a look-up each, since many lists are held against one."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


_HASHES = "bucket bigint, block bigint, hashes binary"


def hashes_of(blocks: DataFrame, buckets: int) -> DataFrame:
    """Per block and bucket the distinct least hashes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = _Block(row)
            found = np.unique(block.stretch)
            where = _dealt(found, buckets)
            order = np.argsort(where, kind="stable")
            cuts = np.flatnonzero(np.diff(where[order])) + 1
            parts = [p for p in np.split(order, cuts) if len(p)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(where[p[0]]) for p in parts], pa.int64()),
                    pa.array([block.number] * len(parts), pa.int64()),
                    pa.array([_shortened(found[p]) for p in parts], pa.binary()),
                ],
                names=["bucket", "block", "hashes"],
            )

    return blocks.select("block", "ids", "absent", "lengths", "body").mapInArrow(make, _HASHES)


def shared_hashes(hashes: DataFrame) -> DataFrame:
    """Per block and bucket those hashes that another block has too."""

    def compare(table: pa.Table) -> pa.Table:
        lists = [_lengthened(x.as_py()) for x in table.column("hashes")]
        every, counts = np.unique(np.concatenate(lists), return_counts=True)  # distinct within each block
        shared = every[counts > 1]
        out = [_shortened(one[_among(one, shared)]) for one in lists]
        kept = [i for i, one in enumerate(out) if one]
        return pa.table({"block": table.column("block").take(pa.array(kept, pa.int64())), "hashes": pa.array([out[i] for i in kept], pa.binary())})

    return hashes.groupBy("bucket").applyInArrow(compare, "block bigint, hashes binary")


_SENT = "bucket bigint, block bigint, windows bigint, places binary, counts binary, docs binary, body binary"


def settle_within(joined: DataFrame, buckets: int) -> DataFrame:
    """Step 3. Rows of bucket -1 hold the windows settled within a block (places and counts of stretches)."""
    names = [f.split()[0] for f in _SENT.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.binary()] * 4

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = _Block(row)
            parts = [_lengthened(x) for x in row["shared"] or []]
            shared = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
            outside = _among(block.stretch & _LOW, shared)
            _, inverse, counts = np.unique(block.stretch, return_inverse=True, return_counts=True)
            again = counts[inverse] > 1
            flags = np.zeros(len(block.least) + 1, bool)

            # Windows whose hash the block has in several stretches, by rising document.
            starts = _windows(block.starts[again], block.stops[again])
            starts = starts[np.argsort(block.ids_at(starts), kind="stable")]
            leader = sorted_classes(block.text, starts)
            own = block.ids_at(starts)
            gone = starts[own > own[leader]]
            flags[gone] = True
            at, until = _runs(flags[:-1])
            if len(at):
                yield _row(names, kinds, -1, block.number, len(gone), at.tobytes(), (until - at).tobytes(), b"", b"")

            # What other blocks may have, without what is settled.
            wanted = np.zeros(len(block.least) + 1, bool)
            wanted[_windows(block.starts[outside], block.stops[outside])] = True
            wanted[gone] = False
            edge = np.zeros(len(wanted), bool)
            edge[block.starts] = True
            begin = np.flatnonzero(wanted & (edge | ~np.concatenate([[False], wanted[:-1]])))
            finish = np.flatnonzero(wanted & np.concatenate([edge[1:] | ~wanted[1:], [True]])) + 1
            if not len(begin):
                continue
            where = _dealt(block.least[begin], buckets)
            order = np.argsort(where, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(where[order])) + 1):
                first, number = begin[part], finish[part] - begin[part]
                body = _gathered(block.text, first, number + LENGTH - 1)
                yield _row(
                    names,
                    kinds,
                    int(where[part[0]]),
                    block.number,
                    int(number.sum()),
                    first.tobytes(),
                    number.tobytes(),
                    block.ids_at(first).tobytes(),
                    _packed(body.tobytes()),
                )

    return joined.mapInArrow(make, _SENT)


def _windows(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return _gathered(np.arange(stops[-1]), starts, stops - starts) if len(starts) else np.zeros(0, np.int64)


def settle_between(sent: DataFrame) -> DataFrame:
    """Step 4. Per bucket and block the windows that start in a smaller document of another block."""

    def compare(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        places = [np.frombuffer(r["places"], np.int64) for r in rows]
        counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
        docs = np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows])
        owner = np.repeat(np.arange(len(rows)), [len(p) for p in places])
        place = np.concatenate(places)
        lengths = counts + LENGTH - 1
        sizes = np.add.reduceat(lengths, np.cumsum([0, *(len(p) for p in places[:-1])]))
        text = np.frombuffer(b"".join(_unpacked(r["body"], n) for r, n in zip(rows, sizes, strict=True)), np.uint8)
        begins = np.cumsum(lengths) - lengths
        piece = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        order = np.argsort(docs[piece], kind="stable")
        starts = (begins[piece] + within)[order]
        leader = sorted_classes(text, starts)
        own = docs[piece][order]
        gone = np.zeros(len(piece), bool)
        gone[order] = own > own[leader]
        # Stretches of such windows, in the places of their blocks.
        first = gone & ~(np.concatenate([[False], gone[:-1]]) & (within > 0))
        at = np.flatnonzero(first)
        number = np.add.reduceat(gone[np.flatnonzero(gone)], np.searchsorted(np.flatnonzero(gone), at)) if len(at) else at
        where, owners = place[piece[at]] + within[at], owner[piece[at]]
        cuts = np.searchsorted(owners, np.arange(len(rows) + 1))
        found = [i for i in range(len(rows)) if cuts[i + 1] > cuts[i]]
        return pa.table(
            {
                "block": pa.array([rows[i]["block"] for i in found], pa.int64()),
                "places": pa.array([where[cuts[i] : cuts[i + 1]].tobytes() for i in found], pa.binary()),
                "counts": pa.array([number[cuts[i] : cuts[i + 1]].astype(np.int64).tobytes() for i in found], pa.binary()),
            }
        )

    return sent.groupBy("bucket").applyInArrow(compare, "block bigint, places binary, counts binary")


def cut(joined: DataFrame, keep_text: bool) -> DataFrame:
    """Step 5: documents without the bytes of the windows found."""
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    names = [f.split()[0] for f in schema.split(", ")]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = _Block(row, hashes=False)
            change = np.zeros(len(block.text) + 1, np.int32)
            for places, counts in row["found"] and [(f["places"], f["counts"]) for f in row["found"]] or []:
                at = np.frombuffer(places, np.int64)
                np.add.at(change, at, 1)
                np.subtract.at(change, at + np.frombuffer(counts, np.int64) + LENGTH - 1, 1)
            removed = np.cumsum(change[:-1]) > 0
            out, at = [], 0
            for length in block.lengths.tolist():
                gone = removed[at : at + length]
                lost = int(gone.sum())
                kept = block.text[at : at + length][~gone].tobytes() if lost else block.body[at : at + length]
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (length > 0 and gone[0]))
                out.append((length, lost, spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                at += length
            ids = pa.array(block.ids, mask=block.absent)
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            arrays = [ids, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.mapInArrow(make, schema)


def _dealt_once(blocks: DataFrame) -> DataFrame:
    """Blocks written as a table bucketed by their number, so that no join by it moves a text again."""
    spark = blocks.sparkSession
    spread, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"text_blocks_{uuid.uuid4().hex}"
    dealt = blocks.repartition(spread, "block").write.bucketBy(spread, "block")
    dealt.option("path", scratch_path(spark, "text-blocks")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are outside the warehouse
    return table


def suffix_dedup(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    block_bytes: int = BLOCK_BYTES,
    bucket_hashes: int = BUCKET_HASHES,
    bucket_windows: int = BUCKET_WINDOWS,
    keep_text: bool = False,
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the bytes kept."""
    blocks = _dealt_once(blocks_of(docs, text, doc_id, block_bytes))
    # Sizes decide numbers of buckets only: about one stretch per sixteen bytes.
    number = blocks.count()
    buckets = max(1, number * block_bytes // 16 // bucket_hashes)
    shared = shared_hashes(hashes_of(blocks, buckets)).groupBy("block").agg(F.collect_list("hashes").alias("shared"))
    shared = settle_table(shared, "shared-hashes")
    joined = blocks.join(shared, "block", "left")
    # At most one window per byte is sent, and about a fifth of that in texts with many repeats.
    sent = settle_table(settle_within(joined, max(1, number * block_bytes // 6 // bucket_windows)), "windows")
    between = settle_between(sent.filter("bucket >= 0"))
    within = sent.filter("bucket = -1").select("block", "places", "counts")
    found = within.unionByName(between).groupBy("block").agg(F.collect_list(F.struct("places", "counts")).alias("found"))
    return cut(blocks.join(found, "block", "left"), keep_text)
