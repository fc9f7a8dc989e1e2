"""Whitening of embeddings along their leading components, found by a block Jacobi-Davidson method.

The covariance is never formed: a product with it is a pass over the vectors, in which each task multiplies its centred rows by a few directions and
back, and sums by dimension come to the driver. The driver keeps a small subspace. In each round the subspace gives Ritz pairs; leading pairs
whose residuals are down to double precision are locked and taken out; for the others the correction equations, projected away from locked
and current directions, are solved roughly by MINRES, all in step so that one pass serves all of them, and the corrections enlarge the subspace.

Entries become whole numbers, ``floor(scale * c) + offset``, so sums by dimension are exact and a centred entry is ``(n * x - S) / n`` with one rounding.
The table of whole numbers lies in the checkpoint folder; what the driver and the tasks' closures hold is ``dimensions * (wanted + a subspace)``
numbers, whatever the rows.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are dropped; a shorter vector counts as if filled up with
zeros to the longest; ids may be null or repeat, each row is its own; equal vectors count as often as they come; components whose
variance is zero to double precision are left out, so a table of one vector, of equal vectors or of none gives no rows; entries
beyond 2**43 times ``1 / scale`` count as that; a deviation beyond 64 bits is null; a component has its largest entry positive; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacurate.session import settle_table

WANTED = 8
SCALE, OFFSET = 1024, 100_000
_MOST = 2**43
_EPS = np.finfo(float).eps
#: A residual is down to double precision at this share of the largest eigenvalue.
TOLERANCE = 128 * _EPS
INNER = 8
_ROUNDS = 300
#: Rows whose products are summed at once.
_SLICE = 4096


# --- the method, for any symmetric product ------------------------------------------


def _against(made: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """``made`` without its parts along the orthonormal ``bases``."""
    for _ in range(2):
        for basis in bases:
            made = made - basis @ (basis.T @ made)
    return made


def corrections(product: Callable, theta: np.ndarray, residuals: np.ndarray, away: np.ndarray, steps: int = INNER, goal: float = 1e-3) -> np.ndarray:
    """Rough solutions t, orthogonal to ``away``, of (I - QQ')(A - theta I)(I - QQ') t = -r, a column for each pair, by MINRES."""
    v = _against(-residuals, away)
    first = np.linalg.norm(v, axis=0)
    v, eta, beta = v / first, first.copy(), np.zeros_like(first)
    zeros = np.zeros_like(v)
    before, w, w_before, solved = zeros, zeros, zeros, zeros.copy()
    c = c_before = np.ones_like(first)
    s = s_before = np.zeros_like(first)
    for _ in range(steps):
        p = _against(product(v) - v * theta, away)
        alpha = np.einsum("ij,ij->j", v, p)
        p = p - alpha * v - beta * before
        following = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_before * s * beta
        rho = np.maximum(np.hypot(delta, following), np.finfo(float).tiny)
        rho2, rho3 = s * alpha + c_before * c * beta, s_before * beta
        c_before, s_before, c, s = c, s, delta / rho, following / rho
        w, w_before = (v - rho3 * w_before - rho2 * w) / rho, w
        solved += c * eta * w
        eta = -s * eta
        if np.all(np.abs(eta) <= goal * first) or np.any(following <= _EPS * np.abs(theta)):
            break
        before, v, beta = v, p / following, following
    return _against(solved, away)


def _enlarged(made: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``made`` adds to ``bases``."""
    kept = np.zeros((made.shape[0], 0))
    for column in made.T:
        length = np.linalg.norm(column)
        rest = _against(column[:, None], *bases, kept)
        if length and np.linalg.norm(rest) > 1e-8 * length:
            kept = np.hstack([kept, _against(rest / np.linalg.norm(rest), *bases, kept)])
            kept[:, -1] /= np.linalg.norm(kept[:, -1])
    return kept


def eigenpairs(product: Callable, dimensions: int, wanted: int = WANTED, tolerance: float = TOLERANCE, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    wanted = min(wanted, dimensions)
    draw = np.random.default_rng(seed)
    most = max(6 * wanted, wanted + 20)
    locked, values = np.zeros((dimensions, 0)), []
    basis = _enlarged(draw.standard_normal((dimensions, min(dimensions, 2 * wanted))))
    image = product(basis)
    best, stuck = np.inf, 0
    for _ in range(_ROUNDS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        open_pairs = wanted - len(values)
        vectors, ritz = basis[:, :open_pairs], theta[:open_pairs]
        residuals = _against(image[:, :open_pairs] - vectors * ritz, locked)
        sizes = np.linalg.norm(residuals, axis=0)
        largest = max(abs(x) for x in [*values[:1], ritz[0]])
        whole = basis.shape[1] + len(values) >= dimensions
        worst = sizes.max()
        stuck, best = (stuck + 1, best) if worst > best / 2 else (0, worst)
        # rounding in the sums may keep residuals just above the tolerance; then they no longer fall
        small_enough = tolerance * largest if not whole and (stuck < 3 or worst > 1e-11 * largest) else np.inf
        done = int(np.argmax(np.append(sizes > small_enough, True)))  # the leading pairs that are through
        if done:
            locked = np.hstack([locked, vectors[:, :done]])
            values += theta[:done].tolist()
            basis, image, best, stuck = basis[:, done:], image[:, done:], np.inf, 0
            if len(values) == wanted:
                order = np.argsort(values)[::-1]
                return np.array(values)[order], locked[:, order]
            vectors, ritz, residuals, sizes = vectors[:, done:], ritz[done:], residuals[:, done:], sizes[done:]
        if basis.shape[1] + len(ritz) > most:
            basis, image = basis[:, : 2 * wanted], image[:, : 2 * wanted]
        unsettled = sizes > tolerance * largest
        made = corrections(product, ritz[unsettled], residuals[:, unsettled], np.hstack([locked, vectors]))
        made = _enlarged(made, locked, basis)
        if not made.shape[1]:
            made = _enlarged(draw.standard_normal((dimensions, 1)), locked, basis)
        basis, image = np.hstack([basis, made]), np.hstack([image, product(made)])
    raise ArithmeticError("the residuals do not fall to double precision")


# --- over rows ---------------------------------------------------------------------


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str, scale: int, offset: int) -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that count, x as 64-bit numbers side by side, and how many a row has."""
    given = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    finite = given.filter(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    dimensions = finite.agg(F.max(F.size("v"))).first()[0] or 0

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            rows = np.zeros((batch.num_rows, dimensions))
            rows[np.arange(dimensions) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            x = np.clip(np.floor(scale * rows), -_MOST, _MOST).astype("<i8") + offset
            body = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), body], names=["vec_id", "x"])

    return settle_table(finite.mapInArrow(make, "vec_id bigint, x binary"), "whole-numbers"), dimensions


def _numbers(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dimensions)


def _slices(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            yield _numbers(batch.column(batch.num_columns - 1).slice(at, _SLICE), dimensions)


def summed(table: DataFrame, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], dimensions: int, kind: str = "double") -> np.ndarray:
    """The sum of ``of(x)`` over slices x of all rows: summed by each task, then by row of the sum."""
    names = [f"c{i}" for i in range(shape[1])]
    dtype = np.float64 if kind == "double" else np.int64

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype)
        for x in _slices(batches, dimensions):
            total += of(x)
        columns = [pa.array(np.arange(shape[0], dtype=np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in total.T)]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *names])

    parts = table.select("x").mapInArrow(make, ", ".join(["row int", *(f"{n} {kind}" for n in names)]))
    out = np.zeros(shape, dtype)
    for found in parts.groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).collect():
        out[found.row] = found[1:]
    return out


def _deviations(spread: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, exact; null beyond 64 bits."""
    if float(np.abs(spread.astype(float)).max(initial=0)) ** 2 * spread.shape[1] < 2.0**62:
        return np.einsum("ij,ij->i", spread, spread).tolist()
    exact = [sum(v * v for v in row) for row in spread.tolist()]
    return [e if e < 2**63 else None for e in exact]


def whitened(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", wanted: int = WANTED, scale: int = SCALE, offset: int = OFFSET
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component.

    ``deviation`` is the squared distance of n times the row from the sum of all; ``explained`` the component's share of the whole variance;
    ``identity_error`` the largest entry, without its sign, of the covariance of ``whitened`` less the identity.
    """
    table, dimensions = whole_numbers(vectors, vec_id, vector, scale, offset)
    n = table.count()
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not n or not dimensions:
        return table.sparkSession.createDataFrame([], schema)
    sums = summed(table, lambda x: x.sum(axis=0)[:, None], (dimensions, 1), dimensions, "bigint")[:, 0]

    def centred(x: np.ndarray) -> np.ndarray:
        return (x * n - sums) / n

    def product(directions: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            rows = centred(x)
            return rows.T @ (rows @ directions)

        return summed(table, of, directions.shape, dimensions) / n

    trace = float(summed(table, lambda x: (centred(x) ** 2).sum(keepdims=True), (1, 1), dimensions)[0, 0]) / n
    if not trace:
        return table.sparkSession.createDataFrame([], schema)
    values, directions = eigenpairs(product, dimensions, wanted)
    kept = values > 2.0**-40 * values[0]
    values, directions = values[kept], directions[:, kept]
    directions = directions * np.sign(np.take_along_axis(directions, np.abs(directions).argmax(axis=0)[None], 0))
    many, scaled = len(values), directions / np.sqrt(values)
    shares = values / trace
    means = summed(table, lambda x: (centred(x) @ scaled).sum(axis=0)[None], (1, many), dimensions) / n

    def squares(x: np.ndarray) -> np.ndarray:
        made = centred(x) @ scaled - means
        return made.T @ made

    error = float(np.abs(summed(table, squares, (many, many), dimensions) / n - np.eye(many)).max())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                x = _numbers(batch.column(1), dimensions)
                rows = np.repeat(np.arange(batch.num_rows), many)
                columns = [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(rows), n)),
                    pa.array(_deviations(x * n - sums), pa.int64()).take(pa.array(rows)),
                    pa.array((centred(x) @ scaled).ravel()),
                    pa.array(np.tile(shares, batch.num_rows)),
                    pa.array(np.full(len(rows), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return table.mapInArrow(make, schema)
