"""PCA whitening of embedding vectors by pivoted Cholesky and one-sided Jacobi.

Every entry c of a vector becomes the integer x = floor(SCALE * c) + SHIFT. Four passes, none of which moves a row:

1. The number of vectors n and the exact sum S of each dimension.
2. The scatter of x - S/n, summed block by block in every task. Entries are centred before they are multiplied: first
   by the whole part of the mean, exactly, then by what is left of it.
3. On the driver, where the d x d scatter is all there is: pivoted Cholesky gives scatter = L L', columns by falling
   pivot; one-sided Jacobi turns the columns of L until they are at right angles. Their squared lengths are the
   eigenvalues and the columns of length one the components. The covariance of the whitened rows is then measured.
4. Every row is projected.

What reaches the driver depends on the dimension alone: d sums and d * (d + 1) / 2 products.

Defined results. A row takes no part if its vector is null or holds a null or non-finite entry, or if its length is not
the commonest one (of equally common lengths the longest). Null or repeated ids and repeated rows count like others. A
component whose eigenvalue is RANK_TOLERANCE of the largest or less has no direction that rounding leaves certain and is
left out, so constant or dependent dimensions only make components fewer; rows that are all equal have none. A deviation
that a long can't hold is null. An empty table gives no rows. Columns besides the id and the vector are not looked at.
Entries are taken to be below 2^40 in size, so that sums of a task's integers stay exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Pivots and eigenvalues up to this share of the largest are taken for rounding.
RANK_TOLERANCE = 1e-12
#: Columns count as at right angles when their cosine is below this.
ANGLE = 1e-15
SWEEPS = 60


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening; `components` has one row for each component, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace


def usable(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """The rows that may take part, as (key, vector)."""
    named = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    return named.where(F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))


def _matrix(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The integers of the vectors of that size, and which rows they are of."""
    at = np.flatnonzero(column.value_lengths().to_numpy(zero_copy_only=False) == size)
    values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)
    return np.floor(SCALE * values).astype(np.int64) + SHIFT, at


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        column = batch.column("vector")
        for size in np.unique(column.value_lengths().to_numpy(zero_copy_only=False)):
            x, at = _matrix(column, int(size))
            n, total = totals.get(int(size), (0, np.zeros(int(size), np.int64)))
            totals[int(size)] = (n + len(at), total + x.sum(axis=0))
    for size, (n, total) in totals.items():
        # Place -1 holds the number of rows.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size + 1, size)), pa.array(np.arange(-1, size)), pa.array(np.r_[n, total])], names=["size", "place", "total"]
        )


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S/n: the whole part goes off exactly, so only the rest of the mean is rounded."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def _products(rows: DataFrame, size: int, made) -> np.ndarray:
    """The sum over all rows of the outer product of what `made` makes of a block of integers."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            z = made(_matrix(batch.column("vector"), size)[0])
            total = z.T @ z + (0 if total is None else total)
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "total"])

    summed = rows.mapInArrow(partial, "i long, j long, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    found = summed.toArrow()
    i, j = found.column("i").to_numpy(), found.column("j").to_numpy()
    out = np.zeros((int(j.max()) + 1,) * 2) if len(j) else np.zeros((0, 0))
    out[i, j] = out[j, i] = found.column("total").to_numpy()
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L'. A row of L belongs to the same row of a; columns come by falling pivot, as many as the rank."""
    left, columns = np.diag(a).copy(), []
    least = RANK_TOLERANCE * left.max(initial=0)
    done = np.zeros(len(a), bool)
    while not done.all():
        pivot = int(np.argmax(np.where(done, -1, left)))
        if left[pivot] <= least:
            break
        column = a[:, pivot] - sum((c * c[pivot] for c in columns), np.zeros(len(a)))
        column /= np.sqrt(left[pivot])
        column[done] = 0  # rows of earlier pivots: the factor is triangular in the order of pivots
        done[pivot] = True
        left = left - column**2
        columns.append(column)
    return np.array(columns).T if columns else np.zeros((len(a), 0))


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and components (one a row) of factor @ factor.T: the factor's columns turned to right angles."""
    u = factor.T.copy()  # one column of the factor in each row
    for _ in range(SWEEPS):
        turned = False
        for p in range(len(u) - 1):
            for q in range(p + 1, len(u)):
                a, b, c = u[p] @ u[p], u[q] @ u[q], u[p] @ u[q]
                if abs(c) <= ANGLE * np.sqrt(a * b):
                    continue
                turned = True
                slope = (b - a) / (2 * c)
                t = (1 if slope >= 0 else -1) / (abs(slope) + np.hypot(1, slope))
                cosine = 1 / np.hypot(1, t)
                u[p], u[q] = cosine * (u[p] - t * u[q]), cosine * (u[q] + t * u[p])
        if not turned:
            break
    values = (u * u).sum(axis=1)
    order = np.argsort(-values, kind="stable")
    values, u = values[order], u[order]
    kept = values > RANK_TOLERANCE * values.max(initial=0)
    return values[kept], u[kept] / np.sqrt(values[kept])[:, None]


def fit(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable rows, or None without any."""
    own = usable(rows, vector, key)
    sums = own.mapInArrow(_sums, "size long, place long, total long").groupBy("size", "place").agg(F.sum("total").alias("total"))
    counted = {(r.size_, r.place): r.total for r in sums.withColumnRenamed("size", "size_").collect()}
    if not counted:
        return None
    n, size = max((total, size) for (size, place), total in counted.items() if place < 0)
    totals = tuple(counted[size, place] for place in range(size))
    scatter = _products(own, size, lambda x: _centred(x, n, totals))
    values, vectors = jacobi(pivoted_cholesky(scatter))
    values, vectors, trace = values[:components] / n, vectors[:components], float(np.trace(scatter)) / n
    weights = vectors.T / np.sqrt(values)
    covariance = _products(own, size, lambda x: _centred(x, n, totals) @ weights) / n
    error = float(np.abs(covariance - np.eye(len(values))).max(initial=0.0))
    return Whitening(n, totals, values, vectors, trace, error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The exact sum over dimensions of (n * x - S)^2 of each row."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    near = x - whole
    if len(sums) * (n * (int(np.abs(near).max(initial=0)) + 1)) ** 2 < 2**63:  # no sum leaves the range of a long
        away = n * near - rest
        return (away * away).sum(axis=1).tolist()
    exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, rest, strict=True)) for row in near]
    return [d if d < 2**63 else None for d in exact]


def whiten(rows: DataFrame, model: Whitening | None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, deviation, whitened) of every row that took part; `whitened` has one entry for each component."""
    own = usable(rows, vector, key)
    if model is None:
        return own.select("key", F.lit(0).cast("long").alias("deviation"), F.col("vector").alias("whitened")).limit(0)
    size, n, sums = len(model.sums), model.n, model.sums
    weights = model.components.T / np.sqrt(model.eigenvalues)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = _matrix(batch.column("vector"), size)
            z = _centred(x, n, sums) @ weights
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
            keys = batch.column("key").take(pa.array(at))
            yield pa.RecordBatch.from_arrays([keys, pa.array(_deviations(x, n, sums), pa.int64()), lists], names=["key", "deviation", "whitened"])

    kind = own.schema["key"].dataType.simpleString()
    return own.mapInArrow(projected, f"key {kind}, deviation long, whitened array<double>")
