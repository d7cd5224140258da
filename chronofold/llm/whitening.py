"""Embedding whitening: leading principal components of all rows, each scaled to unit variance.

Components x become floor(scale * c) + SHIFT, whole numbers. The fit list holds each distinct vector once and is written
to the shared folder, as several passes read it; every pass folds a task's rows to one small matrix, and Spark sums
those by matrix row, so that the driver sees one matrix whatever the number of rows and tasks.

A pass multiplies the covariance V by a basis Q: V Q is the mean of r (r Q) over centred rows r. Passes:
1. counts and exact sums, hence the means; rows are centred as (x - S div n) - (S mod n) / n before they are multiplied;
2. the range finder: Q spans V Omega of a Gaussian Omega with k + OVERSAMPLE columns, then POWER times V Q, each time made
   orthonormal again; the last pass also gives V Q for the Ritz matrix Q'VQ, whose eigenvectors give the components;
3. the residuals |V u - e u| of the leading k + 1 Ritz pairs (from the same product). An eigenvector's error is at most its
   residual over the gap to the next eigenvalue; if that bound exceeds TOLERANCE for one of k, the basis grows to the full
   dimension, where Q'VQ is V itself and the result exact to rounding;
4. the covariance of the whitened fit list, as a check: identity_error is its largest departure from the identity.

Defined results: vectors that are null, or hold a null or non-finite component, take no part, nor do empty ones or those
of another length than the most frequent (of equally frequent ones the longest); repeated rows and ids get rows each; a
null id is kept; components with no variance (an eigenvalue of 1e-12 of the largest or less) are left out, so equal
vectors, or a single one, give no rows; eigenvalues that are equal leave the choice of components in their space open,
the same for all rows; a deviation beyond 64 bits is null; other columns are ignored; an empty table gives an empty table.
Values beyond 2**53 / scale raise an error, as they are no exact whole numbers any more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.session import bounded_batches, store

SHIFT, SCALE, COMPONENTS = 1_000_000, 64.0, 16
OVERSAMPLE, POWER, TOLERANCE, SEED = 10, 4, 1e-10, 12


@dataclass(frozen=True)
class Model:
    n: int
    sums: np.ndarray  # of x, exact
    vectors: np.ndarray  # a column a component
    values: np.ndarray  # eigenvalues, falling
    trace: float
    identity_error: float
    full: bool  # whether the basis had to grow to the full dimension

    @property
    def width(self) -> int:
        return len(self.sums)


def whole(vectors: DataFrame, vector_col: str, scale: float, *keep: str) -> DataFrame:
    """keep, and x: the vectors that take part as arrays of bigint."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    good = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    large = lambda c: F.when(F.abs(c) * scale < F.lit(2.0**53), F.floor(c * scale)).otherwise(F.raise_error(F.lit("a component is too large for whole numbers")))
    return vectors.where(good).select(*keep, F.transform(v, lambda c: large(c) + F.lit(SHIFT).cast("bigint")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(rows: DataFrame, fold: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of fold(x) over all batches: matrices of one shape, summed in tasks, then by matrix row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                part = fold(_matrix(batch["x"]))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    parts = rows.select("x").mapInArrow(run, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "v")))["v"].alias("v"))
    return np.array([r.v for r in sorted(cells.collect(), key=lambda r: r.i)])


def _centre(n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return sums // n, (sums % n) / n


def fit(rows: DataFrame, k: int = COMPONENTS, oversample: int = OVERSAMPLE, power: int = POWER, tolerance: float = TOLERANCE) -> Model | None:
    """The model of a stored table of distinct x vectors of one length; None without rows or variance."""
    x, at = F.posexplode("x").alias("at", "x"), F.col("at")
    sums = {r[0]: (int(r[1]), int(r[2])) for r in rows.select(x).groupBy(at).agg(F.sum(F.col("x").cast("decimal(38,0)")), F.count(F.lit(1))).collect()}
    if not sums:
        return None
    n, d = sums[0][1], len(sums)
    total = np.array([sums[j][0] for j in range(d)], dtype=object)
    low, part = (a.astype(t) for a, t in zip(_centre(n, total), (np.int64, np.float64)))

    def centred(a: np.ndarray) -> np.ndarray:
        return (a - low).astype(np.float64) - part

    def times(q: np.ndarray) -> np.ndarray:
        """V q, and below it the squares of the centred entries (their sum is n times the trace)."""

        def fold(a: np.ndarray) -> np.ndarray:
            r = centred(a)
            return np.vstack([r.T @ (r @ q), np.full((1, q.shape[1]), (r * r).sum())])

        return _summed(rows, fold) / n

    width = min(d, k + oversample)
    q = np.eye(d) if width == d else np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, width)))[0]
    for step in range(1 if width == d else power + 1):
        product = times(q)
        if width < d and step < power:
            q = np.linalg.qr(product[:-1])[0]
    trace = float(product[-1, 0])
    values, vectors, residual = _ritz(q, product[:-1])
    full = width == d
    if not full:
        gap = np.min(np.abs(values[:, None] - values[None, :]) + np.where(np.eye(width), np.inf, 0), 1)
        worst = (residual / np.maximum(gap, 1e-300))[: k + 1].max()
        if trace > 0 and not worst <= tolerance:
            full = True
            values, vectors, _ = _ritz(np.eye(d), times(np.eye(d))[:-1])
    some = int((values[:k] > max(values[0], 0) * 1e-12).sum()) if trace > 0 else 0
    if not some:
        return None
    values, vectors = values[:some], vectors[:, :some]
    white = vectors / np.sqrt(values)

    def squares(a: np.ndarray) -> np.ndarray:
        w = centred(a) @ white
        return w.T @ w

    error = float(np.abs(_summed(rows, squares) / n - np.eye(some)).max())
    return Model(n, total, vectors, values, trace, error, full)


def _ritz(q: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors and residuals of the basis q, given V q."""
    small = q.T @ product
    values, inner = np.linalg.eigh((small + small.T) / 2)
    values, inner = values[::-1], inner[:, ::-1]
    vectors = q @ inner
    return values, vectors, np.linalg.norm(product @ inner - vectors * values, axis=0)


def _deviations(n: int, sums: np.ndarray, x: np.ndarray) -> list[int | None]:
    """Sums of (n * x - S) ** 2, exact; None beyond 64 bits."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(abs(int(s)) for s in sums))
    if most < 2**62:
        y = n * x - sums.astype(np.int64)
        if int(np.abs(y).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return (y * y).sum(1).tolist()
    out = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in out]


def apply(rows: DataFrame, model: Model, id_col: str) -> DataFrame:
    """A row for each row (id and x) and component."""
    low, part = (a.astype(t) for a, t in zip(_centre(model.n, model.sums), (np.int64, np.float64)))
    white, share = model.vectors / np.sqrt(model.values), model.values / model.trace
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch["x"])
            w = ((x - low).astype(np.float64) - part) @ white
            again = pa.array(np.repeat(np.arange(len(x)), k))
            deviation = pa.array(_deviations(model.n, model.sums, x), pa.int64())
            size = len(x) * k
            columns = [
                batch["id"].take(again), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(size, model.n), pa.int64()), deviation.take(again),
                pa.array(w.ravel(), pa.float64()), pa.array(np.tile(share, len(x)), pa.float64()), pa.array(np.full(size, model.identity_error), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = rows.select("id", *_nothing()).schema
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


RESULT = [("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]


def _nothing() -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in RESULT]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS, scale: float = SCALE, **more) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained and identity_error of each row and component up to k."""
    bounded_batches(vectors.sparkSession)
    rows = whole(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), "vector", scale, "id")
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    model = None
    if sizes is not None:
        rows = rows.where(F.size("x") == sizes[0])
        distinct = store(rows.select("x").distinct(), "vectors")
        model = fit(distinct, k, **more)
    if model is None:
        return vectors.select(id_col).limit(0).select(id_col, *_nothing())
    return apply(rows, model, id_col)
