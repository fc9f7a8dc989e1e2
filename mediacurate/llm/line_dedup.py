"""Reversible line dedup: sharded cuckoo filters in front of exact reference-count tables.

The index keeps, as tables in the shared folder, the references (key, document), the reference counts of all keys (per
batch), the keys that more than one document holds with the document that keeps them, and per shard and batch a layer of
cuckoo filter. An insertion asks the filters first: a key that they do not know is new for sure, and only the others are
looked up in the exact counts, so false positives cost a lookup and never a result. A deletion takes the references
away, works out the keepers of the touched keys anew and takes keys without references out of the filters; what is left
is what insertion of the remaining documents alone would give.

A key is the line without white space at its ends and with A-Z in lower case, as the first 16 bytes of its SHA-256. A very
frequent line is one row per document in the references, which are never grouped by key but combined, and one in the counts.

Defined results: a null or empty text is one empty line; a null id sorts after all others; rows that repeat an id count as one
document, each losing its lines alike; an empty table gives no rows and leaves the index as it is; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacurate.session import settle_table

MIN_CHARS = 10
SHARDS = 256
_WHITE = b" \t\n\x0b\x0c\r"
_LAST = 2**63 - 1  # stands for a null id: after every other
_REFS = "k1 bigint, k2 bigint, doc bigint"


def _stripped(line: bytes) -> bytes:
    return line.strip(_WHITE)


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or (len(key) >= least and len(key.decode()) >= least)


def _digest(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:16]


def line_keys(text: str | None, least: int = MIN_CHARS) -> list[bytes | None]:
    """The digest of each line's key; None where the key is too short to count."""
    keys = map(_stripped, (text or "").encode().lower().split(b"\n"))
    return [_digest(key) if _long_enough(key, least) else None for key in keys]


def references(docs: DataFrame, text: str, doc_id: str, least: int) -> DataFrame:
    """(k1, k2, doc): one row per document and key."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, found = batch.column(0).to_numpy(zero_copy_only=False), [], []
            for value in batch.column(1):
                keys = set(line_keys(value.as_py(), least)) - {None}
                sizes.append(len(keys))
                found.extend(keys)
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            columns = [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(np.repeat(ids, sizes))]
            yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "doc"])

    slim = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST)).alias("doc"), F.col(text).alias("text"))
    return slim.mapInArrow(make, _REFS)


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four, filled and asked by whole arrays of keys."""

    SLOTS, ROUNDS = 4, 500

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def of(cls, k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
        """A filter of the distinct keys given, at most three quarters full."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, len(k1)) / (0.75 * cls.SLOTS)))))
        while True:
            made = cls(np.zeros((buckets, cls.SLOTS), np.uint16))
            if made._fill(k1, k2):
                return made
            buckets *= 2

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # The key is a digest, so its bits are as good as hashes; the shard uses the lowest bits of k1.
        mark = ((k2.view(np.uint64) >> np.uint64(48)) % np.uint64(65_535) + np.uint64(1)).astype(np.uint16)
        first = (k1.view(np.uint64) >> np.uint64(20)) & np.uint64(len(self.table) - 1)
        return mark, first.astype(np.int64), self._other(first.astype(np.int64), mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        spread = (mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return bucket ^ (spread & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _put(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put what finds a free slot in its bucket; True where it did."""
        order = np.argsort(bucket, kind="stable")
        sorted_buckets = bucket[order]
        first = np.searchsorted(sorted_buckets, sorted_buckets)
        turn = np.arange(len(order)) - first  # of those after the same bucket
        free = self.table[sorted_buckets] == 0
        wanted = (np.cumsum(free, axis=1) == turn[:, None] + 1) & free
        fits = wanted.any(axis=1)
        self.table[sorted_buckets[fits], wanted[fits].argmax(axis=1)] = mark[order][fits]
        done = np.zeros(len(order), bool)
        done[order[fits]] = True
        return done

    def _fill(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        mark, bucket, other = self._places(k1, k2)
        left = ~self._put(mark, bucket)
        mark, bucket = mark[left], other[left]
        draw = np.random.default_rng(len(k1))
        for _ in range(self.ROUNDS):
            left = ~self._put(mark, bucket)
            if not left.any():
                return True
            mark, bucket = mark[left], bucket[left]
            # One newcomer per full bucket takes a slot; the one that had it moves to its other bucket.
            _, chosen = np.unique(bucket, return_index=True)
            slot = draw.integers(0, self.SLOTS, len(chosen))
            evicted = self.table[bucket[chosen], slot]
            self.table[bucket[chosen], slot] = mark[chosen]
            mark[chosen] = evicted
            bucket[chosen] = self._other(bucket[chosen], evicted)
        return False

    def has(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        mark, first, other = self._places(k1, k2)
        marks = mark[:, None]
        return (self.table[first] == marks).any(axis=1) | (self.table[other] == marks).any(axis=1)

    def remove(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Take out keys that are known to be in; one copy of a mark each."""
        for mark, *buckets in zip(*self._places(k1, k2), strict=True):
            for bucket in buckets:
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in names]


class LineIndex:
    """The state of an incremental line dedup; its tables are in the session's shared folder."""

    def __init__(self, spark: SparkSession, shards: int = SHARDS, least: int = MIN_CHARS):
        self.spark, self.shards, self.least = spark, shards, least
        self.refs = self._empty(_REFS)
        self.counts = self._empty("shard int, k1 bigint, k2 bigint, refs bigint, keeper bigint")
        self.shared = self._empty("k1 bigint, k2 bigint, refs bigint, keeper bigint")
        self.filters = self._empty("shard int, layer int, filter binary")
        self.layers = 0

    def _empty(self, schema: str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _shard(self):
        return F.pmod("k1", F.lit(self.shards)).cast("int").alias("shard")

    def _layer(self, keys: DataFrame) -> DataFrame:
        """A filter per shard of the keys (shard, k1, k2)."""
        layer = self.layers

        def build(table: pa.Table) -> pa.Table:
            made = CuckooFilter.of(*_numbers(table, "k1", "k2")).dump()
            shard = table.column("shard")[0].as_py()
            return pa.table(
                {"shard": pa.array([shard], pa.int32()), "layer": pa.array([layer], pa.int32()), "filter": [made]}
            )

        return keys.select("shard", "k1", "k2").groupBy("shard").applyInArrow(build, self.filters.schema)

    def _asked(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``maybe``: whether a filter of its shard knows the key."""
        schema = "shard int, k1 bigint, k2 bigint, refs bigint, keeper bigint, maybe boolean"

        def ask(left: pa.Table, right: pa.Table) -> pa.Table:
            k1, k2 = _numbers(left, "k1", "k2")
            known = np.zeros(len(k1), bool)
            for blob in right.column("filter"):
                known |= CuckooFilter.load(blob.as_py()).has(k1, k2)
            return left.append_column("maybe", pa.array(known))

        return keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(ask, schema)

    def insert(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> None:
        """Add documents whose ids are not in the index."""
        refs = settle_table(references(docs, text, doc_id, self.least), "line-refs")
        fresh = refs.groupBy(self._shard(), "k1", "k2").agg(F.count("*").alias("refs"), F.min("doc").alias("keeper"))
        asked = settle_table(self._asked(fresh) if self.layers else fresh.withColumn("maybe", F.lit(False)), "line-asked")
        known = self.counts.groupBy("k1", "k2").agg(F.sum("refs").alias("old"), F.min("keeper").alias("old_keeper"))
        found = asked.filter("maybe").join(known, ["k1", "k2"], "left")
        merged = (
            asked.filter("NOT maybe")
            .select("shard", "k1", "k2", "refs", "keeper", F.lit(0).cast("bigint").alias("old"))
            .union(
                found.select(
                    "shard", "k1", "k2", "refs", F.least("keeper", "old_keeper").alias("keeper"), F.coalesce("old", F.lit(0))
                )
            )
        )
        merged = settle_table(merged, "line-counts")
        grown = merged.filter("refs + old > 1").select("k1", "k2", (F.col("refs") + F.col("old")).alias("refs"), "keeper")
        self.shared = settle_table(
            self.shared.join(grown, ["k1", "k2"], "left_anti").unionByName(grown), "line-shared"
        )
        self.filters = settle_table(self.filters.unionByName(self._layer(merged.filter("old = 0"))), "line-filters")
        self.counts = self.counts.unionByName(merged.select("shard", "k1", "k2", "refs", "keeper"))
        self.refs, self.layers = self.refs.unionByName(refs), self.layers + 1

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> None:
        """Take the documents with these ids out, as if they had never been inserted."""
        gone = ids.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST)).alias("doc")).distinct()
        kept = settle_table(self.refs.join(gone, "doc", "left_anti").select("k1", "k2", "doc"), "line-refs")
        touched = self.refs.join(gone, "doc", "left_semi").select("k1", "k2").distinct()
        touched = settle_table(touched, "line-touched")
        left = (
            kept.join(touched, ["k1", "k2"], "left_semi")
            .groupBy(self._shard(), "k1", "k2")
            .agg(F.count("*").alias("refs"), F.min("doc").alias("keeper"))
        )
        left = settle_table(left, "line-counts")
        lost = touched.join(left, ["k1", "k2"], "left_anti").select(self._shard(), "k1", "k2")

        if self.layers == 1:

            def thin(keys: pa.Table, layers: pa.Table) -> pa.Table:
                held = CuckooFilter.load(layers.column("filter")[0].as_py())
                held.remove(*_numbers(keys, "k1", "k2"))
                return layers.set_column(2, "filter", pa.array([held.dump()]))

            thinned = lost.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(thin, self.filters.schema)
            self.filters = settle_table(thinned, "line-filters")
        untouched = self.counts.join(touched, ["k1", "k2"], "left_anti")
        counts = untouched.unionByName(left.select("shard", "k1", "k2", "refs", "keeper"))
        self.counts = settle_table(counts, "line-counts")
        if self.layers > 1:
            # A mark may be in any of the layers, and the wrong one must not lose it: merge them into one.
            self.layers = 1
            self.filters = settle_table(self._layer(self.counts.select("shard", "k1", "k2").distinct()), "line-filters")
        self.shared = settle_table(
            self.shared.join(touched, ["k1", "k2"], "left_anti").unionByName(
                left.filter("refs > 1").select("k1", "k2", "refs", "keeper")
            ),
            "line-shared",
        )
        self.refs = kept

    def deduplicated(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
        """Per document: doc_id, n_lines, n_dropped, kept_sha256 and the kept text."""
        drops = (
            self.refs.join(self.shared, ["k1", "k2"])
            .filter("doc <> keeper")
            .groupBy("doc")
            .agg(F.collect_list(F.struct("k1", "k2")).alias("drops"))  # at most the lines of one document
        )
        least = self.least

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept"]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            for batch in batches:
                made = []
                for row_id, value, drop in zip(*(batch.column(i) for i in range(3)), strict=True):
                    body = value.as_py() or ""
                    lines = body.split("\n")
                    if drop.is_valid:
                        pairs = drop.values.flatten()
                        halves = np.stack([p.to_numpy(zero_copy_only=False) for p in pairs], axis=1)
                        gone = {half.tobytes() for half in halves}
                        keys = line_keys(body, least)
                        kept = [line for line, key in zip(lines, keys, strict=True) if key not in gone]
                        body = "\n".join(kept)
                        left = len(kept)
                    else:
                        left = len(lines)
                    digest = hashlib.sha256(body.encode()).hexdigest()
                    made.append((row_id.as_py(), len(lines), len(lines) - left, digest, body))
                columns = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] if made else [pa.array([], k) for k in kinds],
                    names=names,
                )

        rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        found = rows.join(drops, F.coalesce(F.col("doc_id"), F.lit(_LAST)) == F.col("doc"), "left")
        return found.select("doc_id", "text", "drops").mapInArrow(
            apply, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string, kept string"
        )


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", batches: int = 2, shards: int = SHARDS) -> DataFrame:
    """Insert ``docs`` in ``batches`` parts (by a hash of the id) and give each document without its repeated lines."""
    index = LineIndex(docs.sparkSession, shards)
    part = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(batches))
    for number in range(batches):
        index.insert(docs.filter(part == number), text, doc_id)
    return index.deduplicated(docs, text, doc_id)


