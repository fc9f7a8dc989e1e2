"""SimHash near-dedup by pigeonhole blocks.

Fingerprints are made in Arrow batches and collapsed to the distinct ones. Sixty-four bits are cut into six runs; two
fingerprints that differ in at most four bits agree on at least two of the runs, so each fingerprint is dealt to the
fifteen pairs of runs, and those with equal bits there meet in a group. A group is searched by growing clusters, which
emits at most one link fewer than it has members, never its pairs. A group of more than ``LIMIT`` members is not
searched but dealt on: its bits not yet shared are again cut into six runs, of which close fingerprints agree on two. So
groups shrink without a cap on partners: with twelve bits left, a group cannot have more than ``LIMIT`` members.

``near_dedup`` is for copies with a similarity of 0.8 or more, whose fingerprints differ in some 15 of 100 bits, too many for 64 bits to leave
blocks that such pairs share and others do not. So its fingerprints are of the same kind but wider, and are cut into blocks of as many bits as
leave groups of about ``GROUP`` rows, in as many blocks as miss a pair with a chance of ``MISS`` (each bit being alike with a chance of
``ALIKE``). Rows with equal bits in a block meet in a group, where fingerprints are compared by Hamming distance; what close ones connect is
dealt to bounded tiles, and there the shingles are compared exactly. A group beyond ``LIMIT`` is dealt to parts, each two of which meet. One
row per component stays.

Defined results: null and wordless texts have fingerprint zero, which links like any other; a text of fewer words
than a shingle is one shingle; a null id never becomes a component's id while the component has another; rows that repeat
an id are kept and judged each by its text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacurate.llm.graph import components
from mediacurate.llm.jaccard_join import TILE_BYTES, TILE_SETS, Bands, set_of, tiles
from mediacurate.session import settle_table, task_count

SHINGLE = 4
DISTANCE = 4
SEED = 42
RUNS = 6
LIMIT = 4096
_SLICE = 16_384
#: Of the corpus stage: shingle, similarity in hundredths, and bits of each 64 that fingerprints of such texts differ in at most.
NEAR_SHINGLE = 5
PERCENT = 80
NEAR_BITS = 20
#: Words of a wide fingerprint that distances are taken from.
COMPARED = 3
#: Rows in a group that blocks are to leave, chance that a bit of two near copies is alike, and that all blocks miss a pair.
GROUP, ALIKE, MISS = 256, 0.84, 1e-5
_FEWEST_BITS = 4
_ODD = 0x9E3779B97F4A7C15
_HALF, _SHIFT = np.uint64(32), np.uint64(29)
_ROWS = 255  # bits of so many hashes are added up in a byte


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each number spread over all 64 bits, one to one."""
    x = (x ^ (x >> _HALF)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _SHIFT)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> _HALF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of ``text`` over its word shingles, repeats included."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z, and the white space of ASCII
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths) + np.arange(len(words))
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    pieces = zip(starts, ends[size - 1 :].tolist(), strict=True)
    return majority(np.fromiter((digest(joined[a:b], SEED) for a, b in pieces), np.uint64, len(starts)))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of ``hashes`` have set."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SLICE):
        bits = np.unpackbits(hashes[at : at + _SLICE].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp), fp as the signed number of the same bits."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(make, "doc_id bigint, fp bigint")


def refine(mask: int, runs: int = RUNS, distance: int = DISTANCE) -> list[int]:
    """``mask`` with each choice of runs of its unset bits that two close fingerprints may agree on."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    cut = [sum(1 << bit for bit in part.tolist()) for part in np.array_split(free, runs) if len(part)]
    shared = max(1, len(cut) - distance)
    return [mask | sum(chosen) for chosen in combinations(cut, shared)]


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _forest(members: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links of a spanning forest of the close members of one group."""
    ends_a, ends_b = [], []
    left = members
    while len(left) > 1:
        waiting, left = [left[:1]], left[1:]
        while waiting and len(left):
            front = waiting.pop()
            for one in front:
                close = np.bitwise_count(left ^ one) <= distance
                if close.any():
                    found, left = left[close], left[~close]
                    ends_a.append(np.full(len(found), one))
                    ends_b.append(found)
                    waiting.append(found)
    return ends_a, ends_b


def _search(batches: Iterator[pa.RecordBatch], distance: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows (mask, bits, fp) sorted by mask and bits, in; links (0, a, b) and finer rows (mask, bits, fp) out."""
    held = np.zeros((3, 0), np.int64)
    overflowing = None  # mask and bits of a group that is being dealt on

    def rows(mask, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (mask, a, b)], names=["mask", "bits", "fp"])

    def dealt_on(mask: int, members: np.ndarray) -> Iterator[pa.RecordBatch]:
        for finer in map(_signed, refine(int(mask) % 2**64)):
            yield rows(np.full(len(members), finer), members & finer, members)

    def divisible(mask: int) -> bool:
        """With twelve bits left a group has at most 4096 members."""
        return 64 - (int(mask) % 2**64).bit_count() > 12

    def groups(block: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.diff(bounds)
        pairs = bounds[:-1][sizes == 2]
        a, b = block[2, pairs], block[2, pairs + 1]
        close = np.bitwise_count((a ^ b).view(np.uint64)) <= distance
        ends_a, ends_b = [a[close]], [b[close]]
        for at, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            members = block[2, at : at + size]
            if size > limit and divisible(block[0, at]):
                yield from dealt_on(block[0, at], members)
            else:
                more_a, more_b = _forest(members.view(np.uint64), distance)
                ends_a += [x.view(np.int64) for x in more_a]
                ends_b += [x.view(np.int64) for x in more_b]
        a, b = np.concatenate(ends_a), np.concatenate(ends_b)
        if len(a):
            yield rows(np.zeros(len(a), np.int64), a, b)

    for batch in batches:
        block = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
        if overflowing is not None:
            same = (block[0] == overflowing[0]) & (block[1] == overflowing[1])
            if same.any():
                yield from dealt_on(overflowing[0], block[2, same])
                block = block[:, ~same]
            if not block.shape[1]:
                held = block
                continue
            overflowing = None
        starts = np.flatnonzero(np.any(block[:2, 1:] != block[:2, :-1], axis=0)) + 1
        bounds = np.concatenate([[0], starts])
        yield from groups(block, bounds)  # but for the last group, which may go on
        held = np.ascontiguousarray(block[:, bounds[-1] :])
        if held.shape[1] > limit and divisible(held[0, 0]):
            overflowing = (held[0, 0], held[1, 0])
            yield from dealt_on(held[0, 0], held[2])
            held = held[:, :0]
    if held.shape[1]:
        yield from groups(held, np.array([0, held.shape[1]]))


def links(distinct: DataFrame, distance: int = DISTANCE, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``fp`` which chains of close fingerprints connect."""

    def search(batches):
        return _search(batches, distance, limit)

    masks = [F.lit(_signed(mask)) for mask in refine(0)]
    rows = distinct.select(F.explode(F.array(*masks)).alias("mask"), "fp").select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp"
    )
    found = None
    while True:
        grouped = rows.repartition("mask", "bits").sortWithinPartitions("mask", "bits")
        level = settle_table(grouped.mapInArrow(search, "mask bigint, bits bigint, fp bigint"), "blocks")
        some = level.filter("mask = 0").select(F.col("bits").alias("a"), F.col("fp").alias("b"))
        found = some if found is None else found.union(some)
        rows = level.filter("mask <> 0")
        if rows.isEmpty():
            return found


def _rooted(made: DataFrame, distance: int, limit: int) -> DataFrame:
    """(fp, root) for the distinct fingerprints of ``made``: those of one component share a root."""
    if not 0 < distance < RUNS - 1:
        raise ValueError("two of the runs agree for distances from 1 to 4")
    distinct = settle_table(made.select("fp").distinct(), "distinct")
    roots = components(links(distinct, distance, limit))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return rooted.select("fp", F.coalesce("root", "fp").alias("root"))


def near_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    limit: int = LIMIT,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row: the smallest id that chains of links reach."""
    made = settle_table(fingerprints(docs, text, doc_id, shingle), "fingerprints")
    rooted = _rooted(made, distance, limit)
    own = made.groupBy("fp").agg(F.min("doc_id").alias("least")).join(rooted, "fp")
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return made.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def block_bits(rows: int) -> int:
    """Bits of a block that leave groups of about ``GROUP`` of so many rows."""
    return max(_FEWEST_BITS, math.ceil(math.log2(max(1, rows) / GROUP)))


def block_count(bits: int) -> int:
    """Blocks of so many bits that near copies need."""
    return math.ceil(math.log(MISS) / math.log1p(-(ALIKE**bits)))


def wide_fingerprint(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The SimHash of a set's hashes over as many words as its blocks need, each hash being spread anew for each word."""
    words = max(COMPARED, -(-block_count(bits) * bits // 64))
    salts = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(_ODD)
    counts = np.zeros(64 * words, np.int64)
    for at in range(0, len(hashes), _ROWS):
        spread = _mixed(hashes[at : at + _ROWS, None] ^ salts)
        counts += np.unpackbits(spread.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)


def block_keys(prints: np.ndarray, bits: int) -> np.ndarray:
    """A key for each block of each row of wide fingerprints: its place and its bits."""
    many = block_count(bits)
    flat = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little")[:, : many * bits].reshape(len(prints), many, bits)
    return (flat @ (1 << np.arange(bits))) + (np.arange(many) << bits)


def has_partners(size: int, bands: Bands) -> bool:
    """Whether a set of that size can be near one that is not equal to it."""
    return size > 0 and any(bands.runs[band] > 1 for band in bands.of(size))


def blocks_of(hashes: np.ndarray, bands: Bands, bits: int = _FEWEST_BITS) -> np.ndarray:
    """Keys of the blocks of a set's wide fingerprint, none if only equal sets are near it."""
    if not has_partners(len(hashes), bands):
        return np.zeros(0, np.int64)
    return block_keys(wide_fingerprint(hashes, bits)[None], bits)[0]


_TAGS = "at bigint, absent boolean, id bigint, content bigint, n int, d1 bigint, d2 bigint, prints array<bigint>"


def _tagged(docs: DataFrame, text: str, doc_id: str, shingle: int, percent: int, bits: int) -> DataFrame:
    """The rows as they are, each with a number, its shingles' size and digest, and their wide fingerprint."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, at = Bands(percent), TaskContext.get().partitionId() << 33
        for batch in batches:
            contents, sizes, digests, prints = [], [], [], []
            for value in batch.column(2):
                whole = value.as_py() or ""
                hashes = set_of(whole, shingle)
                contents.append(xxhash.xxh3_64_intdigest(whole))
                sizes.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                wanted = has_partners(len(hashes), bands)
                prints.append(wide_fingerprint(hashes, bits).view(np.int64) if wanted else np.zeros(0, np.int64))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prints])]).astype(np.int32)
            flat = np.concatenate(prints) if prints else np.zeros(0, np.int64)
            ids = batch.column(1)
            columns = [
                pa.array(np.arange(at, at + batch.num_rows)), ids.is_null(), ids.fill_null(0),
                pa.array(np.array(contents, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(halves[:, 0]),
                pa.array(halves[:, 1]), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), batch.column(0),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            at += batch.num_rows

    whole = docs.select(F.struct("*").alias("_row"), F.col(doc_id).cast("bigint"), F.col(text).cast("string"))
    schema = f"{_TAGS}, _row {whole.schema[0].dataType.simpleString()}"
    names = [*(c.split()[0] for c in _TAGS.split(", ")), "_row"]
    return settle_table(whole.mapInArrow(make, schema), "tagged")


_PRINTS = [f"p{place}" for place in range(COMPARED)]


def _dealt(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (at, prints) in; a row (key, at, the words that are compared) for each block out."""
    step = 1 + (1 << 16) // block_count(bits)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            some = batch.slice(start, step)
            prints = some.column(1).flatten().to_numpy().view(np.uint64).reshape(some.num_rows, -1)
            keys = block_keys(prints, bits)
            columns = [some.column(0).to_numpy(), *prints.view(np.int64)[:, :COMPARED].T]
            arrays = [pa.array(keys.ravel()), *(pa.array(np.repeat(c, keys.shape[1])) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "at", *_PRINTS])


def _close_pairs(prints: np.ndarray, distance: int, step: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Places of links that connect all close rows of ``prints`` which chains of close rows connect."""
    words, ends_a, ends_b, found = np.ascontiguousarray(prints.T), [], [], 0
    for at in range(0, len(prints) - 1, step):
        differ = np.bitwise_count(words[0, at : at + step, None] ^ words[0, at:])  # up to 192, within a byte
        for word in words[1:]:
            differ += np.bitwise_count(word[at : at + step, None] ^ word[at:])
        a, b = np.nonzero(differ <= distance)
        later = a < b
        ends_a.append(a[later] + at)
        ends_b.append(b[later] + at)
        found += len(ends_a[-1])
        if found > 4 * len(prints):  # many copies: one link each will do
            return _grown(prints, distance)
    return np.concatenate(ends_a), np.concatenate(ends_b)


def _grown(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """The same by growing clusters: one link fewer than rows at most."""
    ends_a, ends_b, left = [], [], np.arange(len(prints))
    while len(left) > 1:
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            one = waiting.pop()
            close = np.bitwise_count(prints[left] ^ prints[one]).sum(axis=1, dtype=np.int64) <= distance
            found, left = left[close], left[~close]
            ends_a.append(np.full(len(found), one))
            ends_b.append(found)
            waiting += found.tolist()
    return np.concatenate(ends_a), np.concatenate(ends_b)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from the least member of each component of (a, b) to its others: they connect the same, by one link fewer than members."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = places[: len(a)], places[len(a) :]
    least = np.arange(len(nodes))
    while len(a):
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, least[a], low)
        np.minimum.at(least, least[b], low)
        while (least != (up := least[least])).any():
            least = up
        apart = least[a] != least[b]
        a, b = a[apart], b[apart]
    others = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[least[others]], nodes[others]


def _meet(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, at, the words that are compared) in the order of their keys, in; links (a, b) out that connect close ones."""
    held = np.zeros((2 + COMPARED, 0), np.int64)

    def links_of(block: np.ndarray, bounds: list[int]) -> Iterator[pa.RecordBatch]:
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, end in zip(bounds, bounds[1:]):
            if end - start > 1:
                a, b = _close_pairs(block[2:, start:end].T.view(np.uint64), distance)
                found_a.append(block[1, start + a])
                found_b.append(block[1, start + b])
        # Near copies meet in many blocks: were each to give a tree of its own, there would be as many links of a row as it has blocks.
        ends = _stars(np.concatenate(found_a), np.concatenate(found_b))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], names=["a", "b"])

    for batch in batches:
        block = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        bounds = [0, *(np.flatnonzero(block[0, 1:] != block[0, :-1]) + 1).tolist()]
        yield from links_of(block, bounds)  # but for the last group, which may go on
        held = block[:, bounds[-1] :].copy()
    yield from links_of(held, [0, held.shape[1]])


def near_links(tagged: DataFrame, bits: int, distance: int = NEAR_BITS, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) of rows (at, prints) that share a block and whose fingerprints are close, enough to connect all such rows."""
    spark, words = tagged.sparkSession, ", ".join(f"{p} bigint" for p in _PRINTS)
    rows = tagged.mapInArrow(lambda batches: _dealt(batches, bits), f"key bigint, at bigint, {words}")
    sizes = rows.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > limit)
    large = settle_table(sizes.select("key", F.ceil(F.col("rows") * 2 / limit).cast("int").alias("parts")), "large")
    if not large.isEmpty():
        mine = F.pmod(F.xxhash64("at"), F.col("parts")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
        parted = rows.join(large, "key", "left").select("*", mine.alias("mine"), other.alias("other"))
        of_two = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))
        rows = parted.select(F.when(F.col("mine").isNull(), F.col("key")).otherwise(of_two).alias("key"), "at", *_PRINTS)
    tasks = max(task_count(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(tasks, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(lambda batches: _meet(batches, distance * COMPARED), "a bigint, b bigint")


def _spanning(sets: list[np.ndarray], prints: np.ndarray, percent: int, distance: int) -> list[tuple[int, int]]:
    """Places (a, b) of links that connect all sets which chains of links connect: close fingerprints, then the shingles."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    links, left = [], np.arange(len(sets))
    while len(left) > 1:
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            one = waiting.pop()
            may = np.bitwise_count(prints[left] ^ prints[one]).sum(axis=1, dtype=np.int64) <= distance
            may &= 100 * np.minimum(sizes[left], sizes[one]) >= percent * np.maximum(sizes[left], sizes[one])
            for place in np.flatnonzero(may).tolist():
                other, mine = sets[left[place]], sets[one]
                at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                both = np.count_nonzero(mine[at] == other)
                may[place] = 100 * both >= percent * (len(mine) + len(other) - both)
            found, left = left[may], left[~may]
            links += [(int(one), int(b)) for b in found]
            waiting += found.tolist()
    return links


def _verify(batches: Iterator[pa.RecordBatch], shingle: int, percent: int, distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (tile, at, the words that are compared, text) in the order of their tiles, in; links (a, b) out."""
    tile, nodes, prints, sets = None, [], [], []

    def ended() -> Iterator[pa.RecordBatch]:
        found = _spanning(sets, np.array(prints, np.int64).reshape(-1, COMPARED).view(np.uint64), percent, distance)
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in x], pa.int64()) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        *plain, texts = batch.columns
        for mine, at, *words, text in zip(*(c.to_pylist() for c in plain), texts, strict=True):
            if mine != tile:
                yield from ended()
                tile, nodes, prints, sets = mine, [], [], []
            nodes.append(at)
            prints.append(words)
            sets.append(set_of(text.as_py(), shingle))
    yield from ended()


def near_dedup(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = NEAR_SHINGLE,
    percent: int = PERCENT,
    distance: int = NEAR_BITS,
    tile_bytes: int = TILE_BYTES,
    tile_sets: int = TILE_SETS,
) -> DataFrame:
    """One row of ``docs`` per component, as it is: the one with the smallest id.

    Rows link when the distinct shingles they share are ``percent`` hundredths or more of those that either has; rows without
    words are alike. A null id goes before any other. Between rows of one id in a component their texts' hashes decide, and
    rows that are the same in both are one.
    """
    spark = docs.sparkSession
    bits = block_bits(docs.count())
    tagged = _tagged(docs, text, doc_id, shingle, percent, bits)
    best = F.min(F.struct("absent", "id", "content", "at")).alias("best")
    chosen = settle_table(tagged.groupBy("n", "d1", "d2").agg(F.min("at").alias("at"), best), "distinct")
    printed = tagged.filter("size(prints) > 0").select("at", "prints").join(chosen.select("at"), "at", "left_semi")
    roots = components(near_links(printed, bits, distance)).withColumnRenamed("node", "at")
    members = settle_table(chosen.select("at", "n").join(roots, "at"), "members")
    words = [F.get("prints", F.lit(place)).alias(name) for place, name in enumerate(_PRINTS)]
    wanted = tagged.select("at", *words, F.col("_row")[text].cast("string").alias("text"))
    placed = tiles(members, percent, tile_bytes, tile_sets).join(wanted, "at").select("tile", "at", *_PRINTS, "text")
    tasks = max(task_count(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.repartition(tasks, "tile").sortWithinPartitions("tile")
    found = dealt.mapInArrow(lambda batches: _verify(batches, shingle, percent, distance * COMPARED), "a bigint, b bigint")
    joined = components(settle_table(found, "joined")).withColumnRenamed("node", "at")
    rooted = chosen.join(joined, "at", "left").groupBy(F.coalesce("root", "at").alias("root"))
    winners = rooted.agg(F.min("best").alias("best")).select("best.at")
    return tagged.join(winners, "at", "left_semi").select("_row.*")
