"""Toxicity by a small convolutional text classifier, trained in numpy and applied in Arrow batches.

Words and their starts are hashed to rows of an embedding table; filters of several widths slide over them, each filter keeps its highest
value in the text, and a logistic output weighs these. Since a filter is a sum over its places, its products with
the embedding table are worked out once per model, and a text then costs one look-up and sum per word and place.

The model is fitted on the driver to at most ``sample`` labelled rows, the first in a hash order of their ids, with
their whole texts; all documents are scored by whole texts, long ones in overlapping pieces. Words stand for their
starts, and only for those that tell the classes apart beyond chance; all others have an embedding of zero, so that no
wrong label is learned by heart. Part of the sample chooses the epoch, and sets the scale of the score and,
per language, the threshold above which a text is flagged. The score sees nothing but the text.

Defined results: null and empty texts get the score of a text without words, whatever the model; labels that are null are not used;
a null id is not held out and not labelled; rows that repeat an id are scored each; without labelled rows of both
classes every score is the share of toxic ones, 0 if there are none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import copy
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacurate.worker import forget_tables

SAMPLE = 6000
#: Texts longer than this many words are not learned from in one go but in pieces of it, the whole text counting.
PIECE = 4096
BUCKETS, WIDTH = 1 << 20, 16
#: Shortest and longest starts of words, in letters.
STARTS = (4, 12)
SIZES, FILTERS = (1, 2, 3), 16
EPOCHS, STEPS, BATCH = 8, 400, 32
RATE, WORD_RATE, BALANCE = 0.003, 3.0, 4.0
THRESHOLD, LEAST_LABELS = 0.7, 50
#: Words in fewer learned texts are not learned.
LEAST_TEXTS = 5
#: Standard deviations within which a word's shares of the two classes count as equal.
CHANCE = 4.0
_KNOWN = 400_000
_EDGES = string.punctuation


def held_out(doc_id):
    """The rows that no label is learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _parts(word: str) -> list[int]:
    """Buckets of the starts of a word, and of the whole of it."""
    bare = word.strip(_EDGES) or word
    starts = [bare[:n] for n in range(STARTS[0], min(len(bare) - 1, STARTS[1]) + 1)]
    return [zlib.crc32(part.encode()) % BUCKETS for part in (*starts, bare + " ")]


def _words(text: str | None) -> list[str]:
    return (text or "").lower().split()


class Words:
    """Row numbers of the words of texts, remembered by word: the row of the start that tells the most, else row 0."""

    def __init__(self, rows: np.ndarray, telling: np.ndarray):
        self._known: dict[str, int] = {}
        self._rows, self._telling = rows, telling

    def of(self, text: str | None) -> np.ndarray:
        known, out = self._known, []
        for word in _words(text):
            number = known.get(word)
            if number is None:
                if len(known) >= _KNOWN:
                    known.clear()
                number = known[word] = max(self._rows[_parts(word)].tolist(), key=self._telling.__getitem__)
            out.append(number)
        return np.asarray(out, np.int64)


def vocabulary(texts: list[str | None], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each bucket, 0 for those that tell nothing, and per row how surely it tells the classes apart.

    A bucket has a row if enough texts have it and its shares of the two classes differ by more than chance.
    """
    parts: dict[str, list[int]] = {}
    having = np.zeros((2, BUCKETS), np.int64)
    for text, label in zip(texts, labels, strict=True):
        found: set[int] = set()
        for word in set(_words(text)):
            if word not in parts:
                if len(parts) >= _KNOWN:
                    parts.clear()
                parts[word] = _parts(word)
            found.update(parts[word])
        having[label, list(found)] += 1
    sizes = np.bincount(labels, minlength=2)
    whole = having.sum(axis=0) / sizes.sum()
    spread = np.sqrt(np.maximum(whole * (1 - whole), 1e-9) * (1 / sizes).sum())
    sure = (having[1] / sizes[1] - having[0] / sizes[0]) / spread
    chosen = np.flatnonzero((having.sum(axis=0) >= LEAST_TEXTS) & (np.abs(sure) > CHANCE))
    rows = np.zeros(BUCKETS, np.int32)
    rows[chosen] = np.arange(1, len(chosen) + 1)
    return rows, np.concatenate([[0.0], sure[chosen]])


@dataclass
class Model:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # by width: (width, WIDTH, FILTERS)
    biases: dict[int, np.ndarray]
    weights: np.ndarray
    bias: float
    rows: np.ndarray  # by bucket
    sure: np.ndarray  # by row
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fresh(cls, rows: np.ndarray, sure: np.ndarray, seed: int = 7) -> Model:
        """Embeddings start from how surely the words tell the classes apart; row 0 is and stays zero."""
        draw = np.random.default_rng(seed)
        f32 = np.float32
        embedding = draw.normal(0, 0.02, (len(sure), WIDTH)).astype(f32)
        embedding[:, 0] = np.clip(sure / CHANCE, -4, 4) / 2
        embedding[0] = 0
        return cls(
            embedding,
            {n: draw.normal(0, 0.3 / np.sqrt(n), (n, WIDTH, FILTERS)).astype(f32) for n in SIZES},
            {n: np.zeros(FILTERS, f32) for n in SIZES},
            draw.normal(0, 0.1, len(SIZES) * FILTERS).astype(f32),
            0.0,
            rows,
            sure,
        )

    def words(self) -> Words:
        return Words(self.rows, np.abs(self.sure))

    def products(self) -> dict[int, list[np.ndarray]]:
        return {n: [self.embedding @ self.filters[n][k] for k in range(n)] for n in SIZES}

    def pooled(self, numbers: np.ndarray, products: dict[int, list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Highest value per filter and its place; texts shorter than a filter have zero and the place -1."""
        values, places = [], []
        for n in SIZES:
            best, where = np.full(FILTERS, -np.inf, np.float32), np.full(FILTERS, -1)
            for at in range(0, max(0, len(numbers) - n + 1), PIECE):
                part = numbers[at : at + PIECE + n - 1]
                room = len(part) - n + 1
                out = sum(products[n][k][part[k : k + room]] for k in range(n))
                top = out.argmax(axis=0)
                height = out[top, np.arange(FILTERS)]
                better = height > best
                best[better], where[better] = height[better], top[better] + at
            lifted = np.maximum(best + self.biases[n], 0)
            where[lifted <= 0] = -1
            values.append(lifted)
            places.append(where)
        return np.concatenate(values), np.concatenate(places)

    def raw(self, numbers: np.ndarray, products: dict[int, list[np.ndarray]]) -> float:
        return float(self.pooled(numbers, products)[0] @ self.weights + self.bias)

    def score(self, numbers: np.ndarray, products: dict[int, list[np.ndarray]]) -> float:
        if self.constant is not None:
            return self.constant
        return float(_logistic(self.slope * self.raw(numbers, products) + self.shift))


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _adam(state: dict, name: str, value: np.ndarray, grad: np.ndarray, step: int) -> None:
    m, v = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
    m += 0.1 * (grad - m)
    v += 0.01 * (grad * grad - v)
    value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)


def _fit(
    model: Model, texts: list[np.ndarray], labels: np.ndarray, others: list[np.ndarray], other_labels: np.ndarray, seed: int
) -> Model:
    """Minibatch training; gradients flow through the places that were highest.

    Of the models after each epoch, the one that explains the ``others`` best is returned.
    """
    draw, state = np.random.default_rng(seed), {}
    balance = np.where(labels == 1, min(BALANCE, (labels == 0).sum() / max(1, (labels == 1).sum())), 1.0)
    step, best, least = 0, model, np.inf
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(texts)))):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            step += 1
            chosen = order[at : at + BATCH]
            products = model.products()
            pooled = [model.pooled(texts[i], products) for i in chosen]
            values = np.stack([p[0] for p in pooled])
            # Half of the pooled values are left out of each step, so that no filter relies on another.
            mask = (draw.random(values.shape) < 0.5) * np.float32(2)
            values = values * mask
            error = (_logistic(values @ model.weights + model.bias) - labels[chosen]) * balance[chosen] / len(chosen)
            error = error.astype(np.float32)
            weight_grad = values.T @ error
            back = np.outer(error, model.weights) * mask
            rows, row_grads = [], []
            grads = {n: np.zeros_like(model.filters[n]) for n in SIZES}
            bias_grads = {n: np.zeros_like(model.biases[n]) for n in SIZES}
            for i, (_, places), signal in zip(chosen, pooled, back, strict=True):
                for j, n in enumerate(SIZES):
                    where, part = places[j * FILTERS : (j + 1) * FILTERS], signal[j * FILTERS : (j + 1) * FILTERS]
                    live = np.flatnonzero(where >= 0)
                    if not len(live):
                        continue
                    bias_grads[n][live] += part[live]
                    for k in range(n):
                        words = texts[i][where[live] + k]
                        grads[n][k][:, live] += model.embedding[words].T * part[live]
                        rows.append(words)
                        row_grads.append((model.filters[n][k][:, live] * part[live]).T)
            for n in SIZES:
                _adam(state, f"filter{n}", model.filters[n], grads[n], step)
                _adam(state, f"bias{n}", model.biases[n], bias_grads[n], step)
            _adam(state, "weights", model.weights, weight_grad + 1e-4 * model.weights, step)
            model.bias -= RATE * 5 * float(error.sum())
            if rows:
                touched, inverse = np.unique(np.concatenate(rows), return_inverse=True)
                total = np.zeros((len(touched), WIDTH), np.float32)
                np.add.at(total, inverse, np.concatenate(row_grads))
                model.embedding[touched] -= WORD_RATE * total
                model.embedding[0] = 0
        products = model.products()
        raw = np.array([model.raw(text, products) for text in others])
        slope, shift = _scale(raw, other_labels)
        loss = _loss(_logistic(slope * raw + shift), other_labels)
        if loss < least:
            best, least = copy.deepcopy(model), loss
    return best


def _loss(chances: np.ndarray, labels: np.ndarray) -> float:
    return -float(np.log(np.where(labels == 1, chances, 1 - chances) + 1e-9).mean())


def _scale(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the raw values probabilities, by Newton's method with a small penalty."""
    slope, shift = 1.0, 0.0
    target = np.where(labels == 1, 1 - 1 / (labels.sum() + 2), 1 / ((labels == 0).sum() + 2))
    for _ in range(50):
        p = _logistic(slope * raw + shift)
        g = np.array([((p - target) * raw).sum() + 0.01 * (slope - 1), (p - target).sum()])
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * raw * raw).sum() + 0.01, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        slope, shift = slope - float(np.clip(move[0], -1, 1)), shift - float(np.clip(move[1], -2, 2))
        if np.abs(move).max() < 1e-6:
            break
    return max(slope, 0.05), shift


def _threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold with the best F1, kept between 0.5 and 0.9; in the middle of the gap around it."""
    best, chosen = -1.0, THRESHOLD
    for t in np.linspace(0.5, 0.9, 41):
        said = scores >= t
        hit = (said & (labels == 1)).sum()
        f1 = 2 * hit / max(1, said.sum() + (labels == 1).sum())
        if f1 > best or (f1 == best and abs(t - THRESHOLD) < abs(chosen - THRESHOLD)):
            best, chosen = f1, float(t)
    return chosen


def train(rows: list[tuple[str | None, int, str | None]], seed: int = 7) -> Model:
    """``rows``: text, label, language; every fifth is set aside to set the scale and the thresholds."""
    labels = np.array([r[1] for r in rows], np.int64)
    if len(rows) == 0 or labels.min() == labels.max():
        model = Model.fresh(np.zeros(BUCKETS, np.int32), np.zeros(1), seed)
        model.constant = float(labels.mean()) if len(rows) else 0.0
        return model
    aside = np.arange(len(rows)) % 5 == 4
    if len(set(labels[aside])) < 2 or len(set(labels[~aside])) < 2:
        aside = np.zeros(len(rows), bool)
    check, learned = np.flatnonzero(aside) if aside.any() else np.arange(len(rows)), np.flatnonzero(~aside)
    model = Model.fresh(*vocabulary([rows[i][0] for i in learned], labels[learned]), seed)
    words = model.words()
    texts = [words.of(r[0]) for r in rows]
    model = _fit(model, [texts[i] for i in learned], labels[learned], [texts[i] for i in check], labels[check], seed)
    products = model.products()
    raw = np.array([model.raw(texts[i], products) for i in check])
    model.slope, model.shift = _scale(raw, labels[check])
    scores = _logistic(model.slope * raw + model.shift)
    languages = np.array([rows[i][2] or "" for i in check])
    for language in sorted(set(languages.tolist())):
        own = languages == language
        if own.sum() >= LEAST_LABELS and len(set(labels[check][own])) == 2:
            model.thresholds[language] = _threshold(scores[own], labels[check][own])
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, text: str, doc_id: str, sample: int):
    """At most ``sample`` labelled rows that are not held out, with their documents; the first in a hash order of the ids."""
    usable = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy("doc_id").agg(F.max(column).alias("_label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # At most ``sample`` rows of two numbers.
    return docs.join(F.broadcast(chosen.withColumnRenamed("doc_id", "_labelled")), F.col(doc_id) == F.col("_labelled"))


def fitted(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, lang: str, label: str, sample: int) -> Model:
    """The model learned from the bounded sample."""
    found = labelled_sample(docs, labels, label, text, doc_id, sample)
    rows = found.select(F.col(text), F.col("_label").cast("int"), F.col(lang), F.xxhash64(doc_id), F.col(doc_id)).collect()
    rows.sort(key=lambda r: (r[3], r[4]))
    return train([(r[0], r[1], r[2]) for r in rows[:sample]])


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    lang: str = "lang",
    label: str = "toxic",
    sample: int = SAMPLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and by its language's threshold flagged."""
    model = fitted(docs, labels, text, doc_id, lang, label, sample)

    # The model travels with the tasks; its size is fixed, whatever the data.
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tables()  # the words of an earlier run's token records
        words, products = model.words(), model.products()
        for batch in batches:
            made = pa.array([model.score(words.of(t.as_py()), products) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), made], names=["doc_id", "lang", "score"])

    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    scored = slim.mapInArrow(score, "doc_id bigint, lang string, score double")
    limit = F.lit(threshold)
    for language, own in sorted(model.thresholds.items()):
        limit = F.when(F.col("lang") == language, F.lit(own)).otherwise(limit)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        limit.alias("threshold"),
        (F.col("score") >= limit).alias("flagged"),
    )


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    lang: str = "lang",
    label: str = "toxic",
    sample: int = SAMPLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that are not flagged, as they are; one pass, no shuffle of texts."""
    model = fitted(docs, labels, text, doc_id, lang, label, sample)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tables()  # the words of an earlier run's token records
        words, products = model.words(), model.products()
        for batch in batches:
            limits = [model.thresholds.get(tongue, threshold) for tongue in batch.column(lang).to_pylist()]
            scores = (model.score(words.of(t.as_py()), products) for t in batch.column(text))
            yield batch.filter(pa.array([s < limit for s, limit in zip(scores, limits, strict=True)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
