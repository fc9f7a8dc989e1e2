"""Exact Jaccard join of word n-gram sets: size-banded tiles, hashed bitmap signatures, sorted-array intersection.

A text's set is the sorted array of the 64-bit hashes of its distinct n-grams; equal sets are one set from then on. Sizes are cut into bands, and
a set goes to the tile of its own band and, if a partner there may be large enough, to that of the next, so that every pair that can link meets
in the tile of its larger set. A tile is cut further before anything is compared:

* Sets that link differ in at most ``d`` n-grams, a number that their band bounds. The space of hashes is cut into more than ``d`` runs, so that
  some run holds the same n-grams in both. Each set gives a key for each run, and sets that share a key in a tile are joined by way of the least
  of them: pairs are never listed. What these links connect is a cluster; sets of different clusters cannot link.
* A cluster of more than ``tile_bytes`` or ``tile_sets`` in a tile is dealt to blocks, and each two blocks are a tile of their own. So a task
  holds two blocks at most, however large the cluster.

Within a tile, sets have bitmaps of the parity of the n-grams that fall on each bit, as wide as the largest set has n-grams. The bits in which
two bitmaps differ are a lower bound for the n-grams in which the sets do, hence an upper bound for their overlap; pairs that pass it are
intersected. A tile gives a spanning forest of its links, one link fewer than its sets at most, and components of all forests are the result.

Runs with fewer than three n-grams say little and would connect much, so there are some runs more than needed, and a set with no more such runs than
that leaves them out: of two linked sets, one more run than that is alike, and it is weak in both or in neither.

Defined results: null, empty and wordless texts have the empty set, which links with nothing, not even itself; a text of fewer words than an
n-gram is one n-gram; whole texts count, however long; rows that repeat an id are judged each by its text; a null id never becomes a component's
id while the component has another; an empty table gives no rows; other columns are ignored. N-grams are told apart by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacurate.llm.graph import components
from mediacurate.session import settle_table, task_count

SHINGLE = 3
PERCENT = 90
#: Of a tile's block: arrays and sets.
TILE_BYTES = 4 << 20
TILE_SETS = 8192
_RATIO = 1.25
_WEAK = 3
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_SHIFT = np.uint64(31)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each number spread over all 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> _SHIFT)


def set_of(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of the distinct n-grams of ``text``."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z, and the white space of ASCII
    if not words:
        return np.zeros(0, np.uint64)
    size = min(shingle, len(words))
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    many = len(words) - size + 1
    made = np.full(many, size, np.uint64)
    for place in range(size):
        made = _mixed((made + each[place : place + many]) * _M1)
    return np.unique(made)


class Bands:
    """Bands of set sizes, with the runs that a tile of the band needs."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.starts = [1]
        self.runs, self.spare = [], []

    def _reach(self, band: int) -> None:
        while len(self.starts) <= band + 1:
            start, end = self.starts[-1], max(self.starts[-1] + 1, int(self.starts[-1] * _RATIO))
            self.starts.append(end)
            differ = (100 - self.percent) * 2 * (end - 1) // (100 + self.percent)
            self.spare.append(differ // 16)
            self.runs.append(differ + 1 + self.spare[-1])

    def of(self, size: int) -> list[int]:
        """The tiles of a set: its own band, and the next if its sets may link with this one."""
        while self.starts[-1] <= size:
            self._reach(len(self.starts))
        band = int(np.searchsorted(self.starts, size, side="right")) - 1
        self._reach(band + 1)
        found = [band]
        if 100 * size >= self.percent * self.starts[band + 1]:
            found.append(band + 1)
        return found

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """A key for each run of each tile; sets that link share one."""
        if not len(hashes):
            return np.zeros(0, np.uint64)
        made, spread = [], _mixed(hashes + _M1)
        for band in self.of(len(hashes)):
            runs = self.runs[band]
            if runs == 1:  # no n-gram may differ: equal sets are one set already
                continue
            run = ((hashes >> np.uint64(32)) * np.uint64(runs)) >> np.uint64(32)  # rising, as the hashes are
            first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            sums, counts = np.add.reduceat(spread, first), np.diff(np.append(first, len(run)))
            places, strong = run[first], counts >= _WEAK
            if runs - np.count_nonzero(strong) <= self.spare[band]:
                places, sums = places[strong], sums[strong]
            else:
                whole = np.zeros(runs, np.uint64)
                whole[places] = sums
                places, sums = np.arange(runs, dtype=np.uint64), whole
            made.append(_mixed(_mixed(sums + np.uint64(band * int(_M1) % 2**64)) + places * _M3))
        return np.concatenate(made) if made else np.zeros(0, np.uint64)


_SETS = "at bigint, doc_id bigint, text string, n int, d1 bigint, d2 bigint, keys array<bigint>"


def sets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The size, digest and keys of each row's set; ``at`` numbers the rows as they were read.

    The text stays beside them, and tiles make the sets anew: hashes are larger than the text and can't be compressed.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, at = Bands(percent), TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes, digests, keys = [], [], []
            for value in batch.column(1):
                hashes = set_of(value.as_py(), shingle)
                sizes.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                keys.append(bands.keys(hashes).view(np.int64))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            columns = [
                pa.array(np.arange(at, at + batch.num_rows)), *batch.columns, pa.array(sizes, pa.int32()),
                pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "doc_id", "text", "n", "d1", "d2", "keys"])
            at += batch.num_rows

    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(make, _SETS)


def bitmaps(flat: np.ndarray, owner: np.ndarray, many: int, width: int) -> np.ndarray:
    """Per set the parity of its hashes on each of ``width`` bits, in words of 64."""
    words = width // 64
    out = np.zeros(many * words, np.uint64)
    place = flat & np.uint64(width - 1)
    np.bitwise_xor.at(out, owner * words + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out.reshape(many, words)


def forest(arrays: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Places (a, b) of links that connect all of ``arrays`` which chains of links connect."""
    sizes = np.array([len(a) for a in arrays], np.int64)
    flat = np.concatenate(arrays)
    width = 64
    while width < sizes.max():
        width *= 2
    maps = bitmaps(flat, np.repeat(np.arange(len(arrays)), sizes), len(arrays), width)
    links, left = [], np.argsort(sizes, kind="stable")
    while len(left) > 1:
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            one = waiting.pop()
            # sizes rise along ``left``: partners are between percent of the size and its inverse
            low = np.searchsorted(sizes[left], -(-percent * sizes[one] // 100))
            high = np.searchsorted(sizes[left], 100 * sizes[one] // percent, side="right")
            near = left[low:high]
            if not len(near):
                continue
            both = sizes[near] + sizes[one]
            least = -(-percent * both // (100 + percent))  # the overlap that a link needs
            differ = np.bitwise_count(maps[near] ^ maps[one]).sum(axis=1, dtype=np.int64)
            may = np.flatnonzero((both - differ) // 2 >= least)
            found = []
            for place in may.tolist():
                other = arrays[near[place]]
                at = np.searchsorted(arrays[one], other)
                at[at == len(arrays[one])] = 0
                if np.count_nonzero(arrays[one][at] == other) >= least[place]:
                    found.append(place)
            if found:
                taken = near[found]
                links += [(int(one), int(b)) for b in taken]
                waiting += taken.tolist()
                left = np.delete(left, low + np.array(found))
    return links


def _compare(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (tile, at, text) in the order of their tiles, in; links (a, b) out."""
    tile, nodes, arrays = None, [], []

    def ended() -> Iterator[pa.RecordBatch]:
        if len(nodes) > 1:
            links = forest(arrays, percent)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in x], pa.int64()) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        for mine, node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if mine != tile:
                yield from ended()
                tile, nodes, arrays = mine, [], []
            nodes.append(node)
            arrays.append(set_of(text.as_py(), shingle))
    yield from ended()


def clusters(keyed: DataFrame) -> DataFrame:
    """(node, root) of the sets (at, keys) that share keys with others, by way of the least set of each key."""
    rows = keyed.select(F.explode("keys").alias("key"), F.col("at").alias("node"))
    hubs = rows.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    met = rows.join(hubs.select("key", "hub"), "key").filter("node <> hub")
    return components(met.select(F.col("hub").alias("a"), F.col("node").alias("b")))


def tiles(members: DataFrame, percent: int, tile_bytes: int, tile_sets: int) -> DataFrame:
    """(tile, at) from (root, at, n): each set in every tile that may have a partner of it."""
    bands = Bands(percent)
    of = F.udf(lambda n: bands.of(n), "array<int>")
    sizes = members.select("n").distinct().select("n", of("n").alias("bands"))  # sizes that occur are far fewer than sets
    placed = members.join(sizes, "n").select("root", "at", "n", F.explode("bands").alias("band"))
    totals = placed.groupBy("root", "band").agg(F.sum(F.col("n").cast("bigint")).alias("grams"), F.count("*").alias("sets"))
    needed = F.greatest(F.ceil(F.col("grams") * 8 / tile_bytes), F.ceil(F.col("sets") / tile_sets)).cast("int")
    blocks = totals.filter("sets > 1").select("root", "band", needed.alias("blocks"))
    mine = F.pmod(F.xxhash64("at"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = placed.join(blocks, ["root", "band"]).select("root", "band", "at", mine.alias("mine"), other.alias("other"))
    return dealt.select(F.xxhash64("root", "band", F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"), "at")


def links(
    table: DataFrame,
    chosen: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    tile_bytes: int = TILE_BYTES,
    tile_sets: int = TILE_SETS,
) -> DataFrame:
    """Links (a, b) between the ``at`` of different sets that connect all which chains of links connect.

    ``chosen`` (at, n) has one row of ``table`` for each set.
    """
    spark = table.sparkSession
    roots = clusters(table.select("at", "keys").join(chosen.select("at"), "at", "left_semi"))
    members = settle_table(chosen.select("at", "n").join(roots.withColumnRenamed("node", "at"), "at"), "members")
    placed = tiles(members, percent, tile_bytes, tile_sets).join(table.select("at", "text"), "at").select("tile", "at", "text")
    tasks = max(task_count(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.repartition(tasks, "tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(lambda batches: _compare(batches, shingle, percent), "a bigint, b bigint")


def similar_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    tile_bytes: int = TILE_BYTES,
    tile_sets: int = TILE_SETS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the smallest id that chains of links reach.

    Two rows link when the n-grams they share are ``percent`` hundredths or more of those that either has.
    """
    table = settle_table(sets(docs, text, doc_id, shingle, percent), "sets")
    some = table.filter("n > 0")
    chosen = settle_table(some.groupBy("d1", "d2", "n").agg(F.min("at").alias("at"), F.min("doc_id").alias("least")), "distinct")
    found = links(some, chosen, shingle, percent, tile_bytes, tile_sets)
    roots = components(settle_table(found, "joined")).withColumnRenamed("node", "at")
    rooted = chosen.join(roots, "at", "left").withColumn("root", F.coalesce("root", "at"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("d1", "d2", "n", "component_id")
    rows = some.select("doc_id", "n", "d1", "d2").join(named, ["d1", "d2", "n"])
    empty = table.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return rows.select("doc_id", "n", "component_id").unionByName(empty).select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id"
    )
