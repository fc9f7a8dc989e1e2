"""Resampling a corpus towards a target distribution: importance weights of hashed features, drawn without replacement.

Each text becomes an array of feature buckets once; corpus and target are summed by bucket, a bucket's gain is the logarithm of its share
in the target over its share in the corpus, and the arrays are scored against the gains. With Gumbel noise from the id, the highest scores are
a draw without replacement. The cutoff is found without sorting the corpus: a quantile sketch brackets it, exact counts of the rows above
and inside the bracket confirm it or widen it, and only the rows of the bracket are sorted, over all tasks, to locate the last row drawn.

What the driver holds is a number for each bucket, ``buckets`` at most, and the bounds. The arrays and the scores are tables in the checkpoint
folder, so a lost executor costs the tasks it ran.

Defined results: null, empty and wordless texts have no features and weight 0; whole texts count, however long; equal scores rank by the smaller
id, a null id last; rows that repeat an id are each scored and ranked, those alike in id and score in the order in which they were read;
a null id takes its noise from an empty one; an empty target has every bucket once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacurate.operators.numbering import global_index
from mediacurate.session import settle_table

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
DRAWN = (10, 100)
SEED = "2024"
ACCURACY = 10_000
#: Distinct words whose buckets a task keeps at once.
_KEPT = 200_000
#: A-Z to a-z, all other ASCII signs but digits and letters to a blank; bytes of other signs stay.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


class _Buckets(dict):
    """Buckets of features, worked out when first asked for."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _KEPT:
            self.clear()
        made = self[feature] = zlib.crc32(feature) % self.buckets
        return made


def features(text: str | None, buckets_of: dict, longest: int = LONGEST) -> tuple[int, np.ndarray]:
    """The number of words of ``text``, and the buckets of all its runs of 1 to ``longest`` words."""
    words = (text or "").encode().translate(_LETTERS).split()
    runs = [words, *([b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] for n in range(2, longest + 1))]
    found = [np.fromiter(map(buckets_of.__getitem__, run), np.uint32, len(run)) for run in runs]
    return len(words), np.concatenate(found)


_ARRAYS = "at bigint, doc_id bigint, n_words bigint, buckets binary, sums array<bigint>"


def bucket_arrays(
    docs: DataFrame, text: str, doc_id: str, buckets: int = BUCKETS, longest: int = LONGEST, rows: bool = True
) -> DataFrame:
    """A row with the feature buckets of each text, and from each task one with the sums of all it has read (``at`` null).

    ``at`` numbers the rows as they were read. Without ``rows`` only the sums come.
    """
    width = "<u2" if buckets <= 2**16 else "<u4"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets_of, sums = _Buckets(buckets), np.zeros(buckets, np.int64)
        at = TaskContext.get().partitionId() << 33
        schema = pa.schema([("at", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.binary()), ("sums", pa.list_(pa.int64()))])
        for batch in batches:
            counts, packed = [], []
            for value in batch.column(1):
                n_words, found = features(value.as_py(), buckets_of, longest)
                sums += np.bincount(found, minlength=buckets)
                if rows:
                    counts.append(n_words)
                    packed.append(found.astype(width).tobytes())
            if rows:
                many = batch.num_rows
                columns = [pa.array(np.arange(at, at + many)), batch.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(many, pa.list_(pa.int64()))], schema=schema)
                at += many
        yield pa.RecordBatch.from_pylist([{"sums": sums.tolist()}] if sums.any() else [], schema=schema)

    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(make, _ARRAYS)


def summed(arrays: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    places = arrays.filter("sums IS NOT NULL").select(F.posexplode("sums").alias("bucket", "n")).filter("n > 0")
    sums = np.zeros(buckets, np.int64)
    for row in places.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        sums[row.bucket] = row.n
    return sums


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the corpus, each bucket counted once more."""
    many, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    shares = zip(source.tolist(), target.tolist(), strict=True)
    exact = [1000 * math.log(float(t + 1) * (all_source + many) / (float(s + 1) * (all_target + many))) for s, t in shares]
    return np.floor(exact).astype(np.int64)


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Thousandths of a Gumbel variate that the id settles."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(arrays: DataFrame, gains: np.ndarray, seed: str = SEED) -> DataFrame:
    """(at, doc_id, n_words, n_features, weight, score) per text."""
    width = "<u2" if len(gains) <= 2**16 else "<u4"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ids, n_words, packed = batch.columns
            n_features, weights, scores = [], [], []
            for doc_id, body in zip(ids.to_pylist(), packed, strict=True):
                found = np.frombuffer(body.as_buffer(), width)
                weight = int(gains[found].sum()) // len(found) if len(found) else 0
                n_features.append(len(found))
                weights.append(weight)
                scores.append(weight + noise(doc_id, seed))
            made = [pa.array(x, pa.int64()) for x in (n_features, weights, scores)]
            yield pa.RecordBatch.from_arrays([at, ids, n_words, *made], names=["at", "doc_id", "n_words", "n_features", "weight", "score"])

    rows = arrays.filter("at IS NOT NULL").select("at", "doc_id", "n_words", "buckets")
    names = ("at", "doc_id", "n_words", "n_features", "weight", "score")
    return rows.mapInArrow(make, ", ".join(f"{n} bigint" for n in names))


def _order():
    return F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("at")


def bracket(eligible: DataFrame, total: int, wanted: int, accuracy: int = ACCURACY) -> tuple[int | None, int | None, int]:
    """Scores (lo, hi) that hold the ``wanted``-th highest of ``total`` between them, and how many rows are above.

    The sketch is off by ``total / accuracy`` ranks; the counts are exact, and a bracket they don't confirm is widened, in the end to all rows.
    """
    middle, spread = 1 - wanted / total, 2 / accuracy
    while True:
        ends = [middle - spread, middle + spread]
        found = eligible.agg(F.percentile_approx("score", F.array(*(F.lit(min(max(e, 0.0), 1.0)) for e in ends)), accuracy)).first()[0]
        lo, hi = found[0] if ends[0] > 0 else None, found[1] if ends[1] < 1 else None
        over = F.lit(False) if hi is None else F.col("score") > hi
        under = F.lit(False) if lo is None else F.col("score") < lo
        above, below = eligible.agg(F.count_if(over), F.count_if(under)).first()
        if above < wanted <= total - below:
            return lo, hi, above
        spread *= 8


def cutoff(eligible: DataFrame, total: int, wanted: int, accuracy: int = ACCURACY):
    """The last row drawn."""
    lo, hi, above = bracket(eligible, total, wanted, accuracy)
    inside = eligible
    if lo is not None:
        inside = inside.filter(F.col("score") >= lo)
    if hi is not None:
        inside = inside.filter(F.col("score") <= hi)
    placed = global_index(inside.select("score", "doc_id", "at"), *_order(), name="place")
    return placed.filter(F.col("place") == wanted - above - 1).first()


def resampled(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    target_text: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least_words: int = LEAST_WORDS,
    drawn: tuple[int, int] = DRAWN,
    seed: str = SEED,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row of ``docs``; the rank is null for rows not drawn.

    Of the rows with ``least_words`` or more, ``drawn[0]`` of every ``drawn[1]`` are drawn.
    """
    arrays = settle_table(bucket_arrays(docs, text, doc_id, buckets, longest), "features")
    wanted_sums = summed(bucket_arrays(target.withColumn("_id", F.lit(None)), target_text, "_id", buckets, longest, rows=False), buckets)
    table = settle_table(scored(arrays, gains_of(summed(arrays, buckets), wanted_sums), seed), "scored")
    eligible = table.filter(F.col("n_words") >= least_words)
    total = eligible.count()
    many = drawn[0] * total // drawn[1]
    rows = table.withColumn("rank", F.lit(None).cast("bigint"))
    if many:
        last = cutoff(eligible, total, many, accuracy)
        after = F.col("at") > last["at"]
        if last["doc_id"] is None:
            tied = F.col("doc_id").isNull() & after
        else:
            tied = F.col("doc_id").isNull() | (F.col("doc_id") > last["doc_id"]) | ((F.col("doc_id") == last["doc_id"]) & after)
        left = (F.col("n_words") < least_words) | (F.col("score") < last["score"]) | ((F.col("score") == last["score"]) & tied)
        placed = global_index(table.filter(~left), *_order(), name="rank").withColumn("rank", F.col("rank") + 1)
        rows = rows.filter(left).unionByName(placed)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")
