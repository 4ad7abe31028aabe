"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Components are held as whole numbers (``floor(scale * c)``), so means and deviations are exact. The
model is fitted on each distinct whole-number vector once:

1. distinct vectors by a group-by, staged; their number and exact sums from per-task sums;
2. the scatter of the centred vectors, one matrix per task, added up in ``MERGES`` tasks;
3. on the driver, on that one matrix: Cholesky with pivoting, which stops where only rounding is
   left; plane rotations then make the columns of the triangular factor orthogonal, directly. The
   squared column norms are the eigenvalues, the normalised columns the components. No product of
   the factor with itself is formed, so small eigenvalues keep their digits.

What is on the driver, or in a task's state, is of the size of one matrix (dimensions squared),
whatever the number of rows.

Rows whose vector is null, or holds null or non-finite entries, or has no entry, are dropped. All
others must agree in length: those of another length than the most frequent (the longer, of equally
frequent ones) are dropped as well. Numbers beyond a long are held at its ends. A component whose
variance is zero, or zero within rounding, cannot be whitened and is left out, so a table of one
distinct vector gives no rows, like an empty one. Repeated ids give repeated rows, a null id stays.
``deviation`` is null where the exact sum is beyond a long. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

SCALE = 256
COMPONENTS = 4
MERGES = 16
_BATCH = 4096
_ROUNDING = float(np.finfo(float).eps)
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """Centre and components of a fit; ``identity_error`` is measured on the fit list."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray  # dimensions x components
    values: np.ndarray  # their variances, falling
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n`` in double precision, the whole part taken off exactly."""
        if not len(self.sums):
            return x.astype(float)
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])
        if _magnitude(x) + max(map(abs, whole)) < _LONG:
            return (x - np.array(whole, np.int64)) - rest
        return x.astype(float) - np.array([float(w) for w in whole]) - rest

    def white(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum over dimensions of ``(n * x - sums) ** 2`` of every row."""
        most = self.n * _magnitude(x) + max(map(abs, self.sums))
        if x.shape[1] * most * most <= _LONG:
            off = self.n * x - np.array(self.sums, np.int64)
            return (off * off).sum(axis=1).tolist()
        exact = [
            sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True))
            for row in x.tolist()
        ]
        return [e if e <= _LONG else None for e in exact]


def _magnitude(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


# -- the matrix -------------------------------------------------------------------------------


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower factor and pivots of a symmetric matrix without negative eigenvalues.

    ``a[pivots][:, pivots]`` is ``factor @ factor.T``; the factor has a column for every pivot above
    rounding.
    """
    rest = np.array(a, float)
    d = len(rest)
    pivots = np.arange(d)
    factor = np.zeros((d, d))
    least = _ROUNDING * d * max(float(np.diag(rest).max(initial=0.0)), 0.0)
    for k in range(d):
        best = k + int(np.argmax(np.diag(rest)[k:]))
        if rest[best, best] <= least:
            return factor[:, :k], pivots
        swap, back = [k, best], [best, k]
        pivots[swap] = pivots[back]
        rest[swap] = rest[back]
        rest[:, swap] = rest[:, back]
        factor[swap] = factor[back]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1 :, k] = rest[k + 1 :, k] / factor[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, pivots


def one_sided_jacobi(factor: np.ndarray, most_sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated until all are orthogonal.

    Columns meet in rounds of disjoint pairs, so a round is one step on whole arrays.
    """
    columns = np.array(factor.T)  # a row per column
    r = len(columns)
    seats = list(range(r + r % 2))  # with an odd number one column rests each round
    for _ in range(most_sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(a, b) for a, b in zip(seats[:half], seats[: half - 1 : -1]) if a < r and b < r]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            left, right = (np.array(side) for side in zip(*pairs, strict=True))
            x, y = columns[left], columns[right]
            xx, yy, xy = ((p * q).sum(axis=1) for p, q in ((x, x), (y, y), (x, y)))
            scale = np.sqrt(xx) * np.sqrt(yy)
            cosine = np.divide(np.abs(xy), scale, out=np.zeros_like(xy), where=scale > 0)
            worst = max(worst, float(cosine.max()))
            turn = cosine > _ROUNDING
            half_gap = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            sign = np.where(half_gap >= 0, 1.0, -1.0)
            tangent = np.where(turn, sign / (np.abs(half_gap) + np.hypot(1.0, half_gap)), 0.0)
            cos = 1 / np.hypot(1.0, tangent)
            sin = cos * tangent
            columns[left] = cos[:, None] * x - sin[:, None] * y
            columns[right] = sin[:, None] * x + cos[:, None] * y
        if worst <= 4 * _ROUNDING:
            break
    return columns.T


def principal(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (as columns) and eigenvalues of a covariance, largest first.

    The entry of largest magnitude of every vector is positive.
    """
    top = float(np.abs(a).max(initial=0.0))
    if not top > 0:
        return np.zeros((len(a), 0)), np.zeros(0)
    power = 2.0 ** np.floor(np.log2(top))  # keeps squares of extreme numbers in range
    factor, pivots = pivoted_cholesky(a / power)
    turned = one_sided_jacobi(factor) if factor.shape[1] > 1 else factor
    norms = np.sqrt((turned * turned).sum(axis=0))
    order = np.argsort(-norms, kind="stable")[:most]
    order = order[norms[order] ** 2 > _ROUNDING * len(a) * norms.max() ** 2]
    vectors = np.zeros((len(a), len(order)))
    vectors[pivots] = turned[:, order] / norms[order]
    strongest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return vectors * np.where(strongest < 0, -1.0, 1.0), norms[order] ** 2 * power


# -- the corpus -------------------------------------------------------------------------------


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))


def _usable(vector: Column) -> Column:
    def finite_entry(c: Column) -> Column:
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    finite = F.forall(vector, finite_entry)
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def _arrays(batches: Iterator[pa.RecordBatch], at: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their vectors as a matrix of longs."""
    for batch in batches:
        for begin in range(0, batch.num_rows, _BATCH):
            part = batch.slice(begin, _BATCH)
            flat = part.column(at).flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(part.num_rows, -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and per-dimension sums of a task, as text, for they may be beyond a long."""
    n, totals = 0, None
    for _, x in _arrays(batches):
        low = (x & 0xFFFFFFFF).sum(axis=0)  # halves, so that no sum can overflow
        high = (x >> 32).sum(axis=0)
        mine = [(int(h) << 32) + int(w) for h, w in zip(high, low, strict=True)]
        totals = mine if totals is None else [a + b for a, b in zip(totals, mine, strict=True)]
        n += len(x)
    if n:
        row = [pa.array([n], pa.int64()), pa.array([[str(t) for t in totals]], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(row, ["n", "sums"])


def _matrix_sum(partials: DataFrame) -> np.ndarray | None:
    """The sum of the tasks' matrices: first in at most ``MERGES`` tasks, then of those."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for cell in batch.column(0):
                matrix = np.frombuffer(cell.as_py(), float)
                total = matrix.copy() if total is None else total + matrix
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["matrix"])

    merged = partials.repartition(MERGES, F.xxhash64("matrix")).mapInArrow(add, "matrix binary")
    parts = [np.frombuffer(r["matrix"], float) for r in merged.collect()]
    return np.sum(parts, axis=0) if parts else None


def _moments(rows: DataFrame, model: Whitening, white: bool) -> np.ndarray | None:
    """Sum of the outer products of the centred (or whitened, with a leading one) fit rows."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _arrays(batches):
            y = model.centred(x)
            if white:
                y = np.hstack([np.ones((len(y), 1)), y @ model.vectors / np.sqrt(model.values)])
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["matrix"])

    total = _matrix_sum(rows.mapInArrow(per_task, "matrix binary"))
    return None if total is None else total.reshape(int(len(total) ** 0.5), -1)


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct rows of ``x``, an array<long> column of one length; None without rows."""
    distinct = stage(rows.select("x").groupBy("x").agg(F.lit(1).alias("_one")).select("x"), "fit")
    parts = distinct.mapInArrow(_sums, "n long, sums array<string>")
    total = F.sum(F.col("sum").cast("decimal(38,0)"))
    merged = parts.select("n", F.posexplode("sums").alias("at", "sum")).groupBy("at").agg(
        F.sum("n").alias("n"), total.cast("string").alias("sum")
    )
    found = merged.orderBy("at").collect()  # a row per dimension
    if not found:
        return None
    n, sums = found[0]["n"], [int(row["sum"]) for row in found]
    bare = Whitening(n, tuple(sums), np.zeros((len(sums), 0)), np.zeros(0), 0.0)
    covariance = _moments(distinct, bare, white=False) / n
    vectors, values = principal(covariance, components)
    model = Whitening(n, tuple(sums), vectors, values, float(np.trace(covariance)))
    if not len(values):
        return model
    moments = _moments(distinct, model, white=True) / n
    spread = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
    error = float(np.abs(spread - np.eye(len(values))).max())
    return replace(model, identity_error=error)


def whiten(
    table: DataFrame,
    components: int = COMPONENTS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """A row per vector and component: (vec_id, component, n, deviation, whitened, explained,
    identity_error)."""
    spark = table.sparkSession
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")).where(_usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    common = lengths.first()
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double,"
        " identity_error double"
    )
    if common is None:
        return spark.createDataFrame([], schema)
    exact = rows.where(F.size("v") == common["d"]).select(whole_numbers(F.col("v"), scale).alias("x"), "vec_id")
    model = fit_whitening(exact, components)
    share = model.values / model.trace if len(model.values) else model.values

    def rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for part, x in _arrays(batches):
            if not k:
                return
            m = len(x)
            each = np.repeat(np.arange(m), k)
            far = model.deviations(x)
            arrays = [
                part.column(1).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n), pa.int64()),
                pa.array([far[i] for i in each], pa.int64()),
                pa.array(model.white(x).ravel()),
                pa.array(np.tile(share, m)),
                pa.array(np.full(m * k, model.identity_error)),
            ]
            names = "vec_id component n deviation whitened explained identity_error".split()
            yield pa.RecordBatch.from_arrays(arrays, names)

    return exact.mapInArrow(rotated, schema)
