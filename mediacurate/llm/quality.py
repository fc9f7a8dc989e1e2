"""Quality by co-training: a classifier of the words and one of the page metadata teach each other.

The text view is a logistic model over hashed words and word pairs (shares of the text); the metadata view is a
logistic model over length, lines and their shape, source and language. Both start from the labelled rows. In every round each view labels
the unlabelled rows it is surest of, as many per class as their share among the labels asks for, and the other
view learns from them too. Both are then put on a probability scale by rows set aside, and the score is the
probability from their weighted log-odds, the weights fitted on the same rows.

At most ``sample`` labelled rows are learned from, the first in a hash order of their ids, and all unlabelled rows that are not held
out. Their features are written once; in each round all of them are scored in Arrow batches, and thresholds at
quantiles over all of them choose the surest. The chosen rows are dealt by a hash of their ids into groups of about ``GROUP``, each group
fits a model to its rows and all of the labelled ones, and the weights of the groups are averaged. So what a task or the
driver holds is the labelled sample and one group. Every document is scored by its whole text, in Arrow batches.

Defined results: null and empty texts have no words and are scored by their metadata and the model's constants; null
metadata count as empty; labels that are null are not used; rows that repeat an id are scored each; without labels of both classes every score
is the share of good ones, 0.5 if there are none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacurate.llm.toxicity import _logistic, _scale, held_out, labelled_sample
from mediacurate.session import settle_table

SAMPLE, GROUP = 4000, 4000
ROUNDS, STEP = 4, 0.05
BUCKETS, NAMES, SHAPES = 1 << 16, 64, 8
THRESHOLD = 0.5
_KNOWN = 400_000


class TextView:
    """Hashed words and pairs of neighbouring words of a text, with their shares."""

    def __init__(self):
        self._known: dict[str, int] = {}

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        known, words = self._known, []
        for word in (text or "").lower().split():
            number = known.get(word)
            if number is None:
                if len(known) >= _KNOWN:
                    known.clear()
                number = known[word] = zlib.crc32(word.encode())
            words.append(number)
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        single = np.asarray(words, np.uint64)
        pairs = (single[:-1] * np.uint64(0x9E3779B1) + single[1:] * np.uint64(0x85EBCA6B)) >> np.uint64(7)
        every = np.concatenate([single, pairs]) % np.uint64(BUCKETS)
        places, counts = np.unique(every, return_counts=True)
        return places.astype(np.int64), counts

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        places, counts = self.counts(text)
        return places, _shares(counts)


def _shares(counts: np.ndarray) -> np.ndarray:
    values = np.sqrt(counts).astype(np.float32)
    return values / np.linalg.norm(values) if len(values) else values


def shape_of(text: str | None) -> np.ndarray:
    """How a page is laid out, without its words."""
    body = text or ""
    lines = body.split("\n")
    lengths = np.fromiter(map(len, lines), np.float64, len(lines))
    n = max(1, len(body))
    distinct = len(set(lines)) / len(lines)
    return np.array(
        [
            np.log1p(len(body)),
            np.log1p(len(lines)),
            np.log1p(lengths.mean()),
            np.log1p(lengths.max()),
            distinct,
            body.count(" ") / n,
            (lengths == 0).mean(),
            lengths.std() / (1 + lengths.mean()),
        ]
    )


def metadata_of(text: str | None, source: str | None, lang: str | None) -> np.ndarray:
    out = np.zeros(SHAPES + 2 * NAMES)
    out[:SHAPES] = shape_of(text)
    out[SHAPES + zlib.crc32((source or "").encode()) % NAMES] = 1
    out[SHAPES + NAMES + zlib.crc32((lang or "").encode()) % NAMES] = 1
    return out


@dataclass
class Model:
    words: np.ndarray
    word_bias: float
    metadata: np.ndarray
    metadata_bias: float
    centre: np.ndarray
    spread: np.ndarray
    scales: tuple[float, float, float, float]  # slope and shift of the text view, then of the metadata view
    share: np.ndarray  # weights of the two log-odds, and a constant
    constant: float | None = None

    def odds(self, words: tuple[np.ndarray, np.ndarray], metadata: np.ndarray) -> tuple[float, float]:
        places, values = words
        text = float(self.words[places] @ values) + self.word_bias
        meta = float((metadata - self.centre) / self.spread @ self.metadata) + self.metadata_bias
        a, b, c, d = self.scales
        return a * text + b, c * meta + d

    def score(self, words: tuple[np.ndarray, np.ndarray], metadata: np.ndarray) -> tuple[float, float, float]:
        if self.constant is not None:
            return (self.constant,) * 3
        text, meta = self.odds(words, metadata)
        both = float(_logistic(self.share[0] * text + self.share[1] * meta + self.share[2]))
        return both, float(_logistic(text)), float(_logistic(meta))


def _fit_words(texts, labels, weights, epochs: int = 12, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic model of sparse rows, by steps that shrink per feature (AdaGrad)."""
    w, bias, squares, bias_square = np.zeros(BUCKETS, np.float32), 0.0, np.full(BUCKETS, 1e-3, np.float32), 1e-3
    draw = np.random.default_rng(3)
    for _ in range(epochs):
        for i in draw.permutation(len(texts)):
            places, values = texts[i]
            error = weights[i] * (float(_logistic(float(w[places] @ values) + bias)) - labels[i])
            grad = error * values + 1e-5 * w[places]
            squares[places] += grad * grad
            w[places] -= rate * grad / np.sqrt(squares[places])
            bias_square += error * error
            bias -= rate * error / np.sqrt(bias_square)
    return w, bias


def _fit_rows(rows, labels, weights, rounds: int = 300, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic model of dense rows, by momentum."""
    w, bias, push, bias_push = np.zeros(rows.shape[1]), 0.0, np.zeros(rows.shape[1]), 0.0
    total = max(weights.sum(), 1e-9)
    for _ in range(rounds):
        error = weights * (_logistic(rows @ w + bias) - labels) / total
        push = 0.9 * push - rate * (rows.T @ error + decay * w)
        bias_push = 0.9 * bias_push - rate * error.sum()
        w, bias = w + push, bias + bias_push
    return w, bias


@dataclass
class _Fitted:
    """Both views, before their scales."""

    words: np.ndarray
    word_bias: float
    metadata: np.ndarray
    metadata_bias: float

    def raw(self, words: tuple[np.ndarray, np.ndarray], row: np.ndarray) -> dict[str, float]:
        text = float(self.words[words[0]] @ words[1]) + self.word_bias
        return {"text": text, "meta": float(row @ self.metadata) + self.metadata_bias}


@dataclass
class _Round:
    """The model of a round, and per view as a teacher the scores up to and from which it labels."""

    model: _Fitted
    limits: dict[str, tuple[float, float]]


_VIEWS = ("text", "meta")
_PUPIL = {"text": "meta", "meta": "text"}
_UNSEEN = {"text": ("shape", "named"), "meta": ("words",)}
_POOL = "doc_id bigint, order double, words binary, shape binary, named array<int>"
#: Sums over rows are of whole numbers, so that they do not depend on the order.
_UNIT, _WEIGHT_UNIT = 1 << 16, 1 << 32


def _packed(places: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising places as differences, and their counts, byte by byte: little more than a byte for each place."""
    gaps = np.diff(places.astype(np.int64), prepend=0).astype("<u2")
    planes = [gaps.view(np.uint8).reshape(-1, 2).T, counts.astype("<u4").view(np.uint8).reshape(-1, 4).T]
    return zlib.compress(b"".join(np.ascontiguousarray(p).tobytes() for p in planes), 1)


def _unpack(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(body), np.uint8)
    many = len(planes) // 6
    gaps = np.ascontiguousarray(planes[: 2 * many].reshape(2, many).T).view("<u2").ravel()
    counts = np.ascontiguousarray(planes[2 * many :].reshape(4, many).T).view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.int64), counts


def _pool_features(free: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """What the views see of (doc_id, order, text, source, lang), as a table in the checkpoint folder.

    Rows whose id is in ``known`` (_labelled) are left out once they are features, so that no text is shuffled.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view = TextView()
        for batch in batches:
            made = []
            for body, where, tongue in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                named = [zlib.crc32((x or "").encode()) % NAMES for x in (where, tongue)]
                made.append((_packed(*view.counts(body)), shape_of(body).tobytes(), named))
            columns = list(zip(*made, strict=True)) or [[]] * 3
            arrays = [*(pa.array(c, pa.binary()) for c in columns[:2]), pa.array(columns[2], pa.list_(pa.int32()))]
            names = ["doc_id", "order", "words", "shape", "named"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=names)

    made = free.mapInArrow(make, _POOL)
    if known is not None:
        # the same plan at every size
        made = made.join(known.hint("merge"), F.col("doc_id") == F.col("_labelled"), "left_anti")
    return settle_table(made, "unlabelled")


def _unpacked(batch) -> Iterator[tuple[int, float, tuple[np.ndarray, np.ndarray] | None, np.ndarray]]:
    """doc_id, order, words and metadata of the rows of a batch or table of features; null columns are not looked at."""
    names = ("doc_id", "order", "words", "shape", "named")
    for doc_id, order, packed, shape, named in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
        row, words = np.zeros(SHAPES + 2 * NAMES), None
        if shape is not None:
            row[:SHAPES] = np.frombuffer(shape)
            row[SHAPES + named[0]] = row[SHAPES + NAMES + named[1]] = 1
        if packed is not None:
            places, counts = _unpack(packed)
            words = places, _shares(counts)
        yield doc_id, order, words, row


def _moments(pool: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows of the pool, and sums and sums of squares of its metadata."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many, sums = 0, np.zeros((2, SHAPES + 2 * NAMES), np.int64)
        for batch in batches:
            for *_, row in _unpacked(batch):
                many += 1
                sums += np.rint(np.stack([row, row * row]) * _UNIT).astype(np.int64)
        arrays = [np.arange(sums.shape[1]), sums[0], sums[1], np.full(sums.shape[1], many)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["at", "one", "two", "many"])

    parts = pool.mapInArrow(add, "at bigint, one bigint, two bigint, many bigint").groupBy("at")
    found = sorted(tuple(r) for r in parts.agg(F.sum("one"), F.sum("two"), F.sum("many")).collect())
    if not found:
        return 0, np.zeros(SHAPES + 2 * NAMES), np.zeros(SHAPES + 2 * NAMES)
    return found[0][3], *(np.array([r[i] for r in found], np.float64) / _UNIT for i in (1, 2))


def _said(history: list[_Round], order: float, words, row: np.ndarray) -> dict[str, int | None]:
    """What the other view has told each pupil about a row: the first label counts."""
    told: dict[str, int | None] = dict.fromkeys(_VIEWS)
    for past in history:
        raw = past.model.raw(words, row)
        for teacher, (low, high) in past.limits.items():
            value = raw[teacher] + order
            if told[_PUPIL[teacher]] is None and (value <= low or value >= high):
                told[_PUPIL[teacher]] = int(value > low)
    return told


def _limits(pool: DataFrame, history: list[_Round], model: _Fitted, centre, spread, share: float, number: int):
    """Per teacher, the scores beyond which lie the ``number`` surest rows not yet told to its pupil; ``share`` of them are good."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {v: [] for v in _VIEWS}
            for _, order, words, row in _unpacked(batch):
                row = (row - centre) / spread
                told, raw = _said(history, order, words, row), model.raw(words, row)
                for v in _VIEWS:
                    out[v].append(raw[v] + order if told[_PUPIL[v]] is None else None)
            yield pa.RecordBatch.from_arrays([pa.array(out[v], pa.float64()) for v in _VIEWS], names=list(_VIEWS))

    scores = settle_table(pool.mapInArrow(score, "text double, meta double"), "scores")
    free = scores.agg(*(F.count(v).alias(v) for v in _VIEWS)).first()
    asked, limits = [], {}
    for v in _VIEWS:
        good = min(free[v], round(number * share))
        bad = min(free[v] - good, number - round(number * share))
        # The quantile at k / n is the k-th value from below.
        low, high = bad / max(free[v], 1), (free[v] - good + 1) / max(free[v], 1)
        asked.append(F.percentile_approx(v, [min(low, 1.0), min(high, 1.0)], 100_000).alias(v))
        limits[v] = (bad > 0, good > 0)
    found = scores.agg(*asked).first()
    return {
        v: (found[v][0] if limits[v][0] else -np.inf, found[v][1] if limits[v][1] else np.inf) for v in _VIEWS if found[v]
    }


def _averaged(pool: DataFrame, history: list[_Round], own: tuple, centre, spread, groups: int) -> dict[str, tuple[np.ndarray, float]]:
    """Per view the mean of the models of the groups, each fitted to the labelled rows ``own`` and the group's rows."""
    texts, rows, labels = own

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [_said(history, o, words, (row - centre) / spread) for _, o, words, row in _unpacked(batch)]
            for v in _VIEWS:
                said = pa.array([t[v] for t in told], pa.int32())
                view = pa.array([v] * batch.num_rows, pa.string())
                # a pupil gets what it looks at
                own = [pa.nulls(batch.num_rows, f.type) if f.name in _UNSEEN[v] else c for f, c in zip(batch.schema, batch.columns, strict=True)]
                whole = pa.RecordBatch.from_arrays([view, said, *own], names=["view", "said", *batch.schema.names])
                yield whole.filter(said.is_valid())

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        view = key[0].as_py()
        found = sorted(zip(_unpacked(table), table.column("said").to_pylist(), strict=True), key=lambda r: (r[0][1], r[0][0]))
        y = np.concatenate([labels, [said for _, said in found]])
        weight = np.concatenate([np.ones(len(labels)), np.full(len(found), 0.5)])
        if view == "text":
            w, bias = _fit_words([*texts, *(r[2] for r, _ in found)], y, weight)
        else:
            w, bias = _fit_rows(np.concatenate([rows, [(r[3] - centre) / spread for r, _ in found]]), y, weight)
        values = np.rint(np.append(w.astype(np.float64), bias) * _WEIGHT_UNIT).astype(np.int64)
        made = {"view": [view] * len(values), "at": np.arange(len(values)), "value": values}
        return pa.table(made, schema=pa.schema([("view", pa.string()), ("at", pa.int64()), ("value", pa.int64())]))

    told = pool.mapInArrow(tell, f"view string, said int, {_POOL}")
    dealt = told.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(groups)))
    fitted = dealt.groupBy("view", "group").applyInArrow(fit, "view string, at bigint, value bigint")
    means = fitted.groupBy("view", "at").agg(F.sum("value").alias("value"), F.count("*").alias("many"))
    # One row per weight of the model.
    collected, out = means.toArrow(), {}
    views, at = np.array(collected.column("view").to_pylist()), collected.column("at").to_numpy()
    mean = collected.column("value").to_numpy() / collected.column("many").to_numpy() / _WEIGHT_UNIT
    for v in set(views.tolist()):
        whole = np.zeros(at[views == v].max() + 1)
        whole[at[views == v]] = mean[views == v]
        out[v] = (whole[:-1].astype(np.float32) if v == "text" else whole[:-1], float(whole[-1]))
    return out


def train(labelled: list[tuple], pool: DataFrame | None, rounds: int = ROUNDS, step: float = STEP, group: int = GROUP) -> Model:
    """``labelled``: text, source, lang, label; ``pool``: the unlabelled rows' features. Every fifth labelled row is set aside."""
    labels = np.array([r[3] for r in labelled], np.float64)
    if not len(labels) or labels.min() == labels.max():
        none = np.zeros(SHAPES + 2 * NAMES)
        constant = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(BUCKETS, np.float32), 0.0, none, 0.0, none, none + 1, (1, 0, 1, 0), np.zeros(3), constant)
    view = TextView()
    texts = [view.of(r[0]) for r in labelled]
    rows = np.stack([metadata_of(r[0], r[1], r[2]) for r in labelled])
    many, one, two = _moments(pool) if pool is not None else (0, 0.0, 0.0)
    n = len(labelled)
    centre = (rows.sum(axis=0) + one) / (n + many)
    square = ((rows * rows).sum(axis=0) + two) / (n + many) - centre * centre
    spread = np.sqrt(np.maximum(square, 0)) + 0.05
    rows = (rows - centre) / spread
    aside = np.arange(n) % 5 == 4
    if len(set(labels[aside])) < 2 or len(set(labels[~aside])) < 2:
        aside = np.zeros(n, bool)
    own = np.flatnonzero(~aside)
    share = labels[own].mean()
    learned = [texts[i] for i in own], rows[own], labels[own]

    model = _Fitted(*_fit_words(learned[0], labels[own], np.ones(len(own))), *_fit_rows(rows[own], labels[own], np.ones(len(own))))
    history: list[_Round] = []
    number = max(2, round(step * many))
    for turn in range(rounds if many else 0):
        history.append(_Round(model, _limits(pool, history, model, centre, spread, share, number)))
        groups = -(-number * (turn + 1) // group)
        made = _averaged(pool, history, learned, centre, spread, groups)
        words = made.get("text", (model.words, model.word_bias))
        model = _Fitted(*words, *made.get("meta", (model.metadata, model.metadata_bias)))

    check = np.flatnonzero(aside) if aside.any() else own
    both = [model.raw(texts[i], rows[i]) for i in check]
    text, meta = (np.array([r[v] for r in both]) for v in _VIEWS)
    a, b = _scale(text, labels[check])
    c, d = _scale(meta, labels[check])
    both = np.stack([a * text + b, c * meta + d], axis=1)
    weights, constant = _fit_rows(both, labels[check], np.ones(len(check)), decay=1e-2)
    return Model(
        model.words, model.word_bias, model.metadata, model.metadata_bias, centre, spread, (a, b, c, d), np.append(weights, constant)
    )


def quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    lang: str = "lang",
    label: str = "quality",
    sample: int = SAMPLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, text_score, metadata_score.

    Labels are learned from rows that are not held out; the pool is all unlabelled rows that are not.
    """
    columns = [F.col(text), F.col(source), F.col(lang)]
    found = labelled_sample(docs, labels, label, text, doc_id, sample)
    labelled = found.select(*columns, F.col("_label").cast("int"), F.xxhash64(doc_id), F.col(doc_id)).collect()
    labelled.sort(key=lambda r: (r[4], r[5]))
    known = labels.select(F.col("doc_id").alias("_labelled"))
    own = docs.select(F.col(doc_id).cast("bigint").alias("_pool"), *(c.alias(f"_c{i}") for i, c in enumerate(columns)))
    free = own.filter(F.col("_pool").isNotNull() & ~held_out(F.col("_pool")))
    # Equal scores are told apart by a hash of the id, far below what a score means.
    order = (F.pmod(F.xxhash64("_pool"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.lit(1e-6)).alias("order")
    learned = [tuple(r[:4]) for r in labelled[:sample]]
    both = len({r[3] for r in learned}) == 2
    seen = free.select(F.col("_pool").alias("doc_id"), order, "_c0", "_c1", "_c2")
    pool = _pool_features(seen, known.distinct()) if both else None
    model = train(learned, pool)

    # The model travels with the tasks; its size is fixed, whatever the data.
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view = TextView()
        names = ["doc_id", "score", "text_score", "metadata_score"]
        for batch in batches:
            made = []
            for body, where, tongue in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
                body = body.as_py()
                made.append(model.score(view.of(body), metadata_of(body, where.as_py(), tongue.as_py())))
            parts = np.array(made, np.float64).reshape(-1, 3)
            columns = [batch.column(0), *(pa.array(parts[:, i].copy()) for i in range(3))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), *columns)
    scored = slim.mapInArrow(score, "doc_id bigint, score double, text_score double, metadata_score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "text_score",
        "metadata_score",
    )
