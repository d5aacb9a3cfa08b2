"""2-D map of feature vectors.

The original fits a t-SNE per batch on one machine and stacks the batches, so
coordinates of different batches are not comparable. Here one PCA is fitted on
all rows and every row is projected with the same model. Component signs are
fixed so that the largest loading of each component is positive.

Vectors may be wide (20,480 components of a picture model), so the d x d
covariance is never formed. Each round multiplies it with a block of ``BLOCK``
directions in one pass over the rows, X'(X Q) with the mean taken off, summed by
a tree. The driver keeps the blocks of all rounds (d x 8 a round) and takes the
best directions in their span (block Krylov method) until those hold; when the
span is the whole space they are exact. Start and rules are fixed, so a fit
depends on the rows alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.operators.arrow import rows_matrix
from featureflow.operators.columns import vector_dim

BLOCK, MAX_ROUNDS, TOLERANCE = 8, 60, 1e-9
#: Partial sums are added up in this many groups, then in so many, then by the driver.
TREE = (4096, 64)


class Projection(NamedTuple):
    """``components``: d x k, a direction a column; ``values``: their variances;
    ``residual``: how far the directions are from holding (share of the first variance)."""

    components: np.ndarray
    values: np.ndarray
    mean: np.ndarray
    n: int
    rounds: int
    residual: float


def finite_rows(col: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold d finite numbers, and those rows as a matrix."""
    valid, x = rows_matrix(col, d)
    good = np.isfinite(x).all(axis=1)
    if not good.all():
        valid = valid.copy()
        valid[np.flatnonzero(valid)[~good]] = False
        x = x[good]
    return valid, x


def sum_over_rows(df: DataFrame, features_col: str, d: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of(matrix of usable rows)``, a vector of fixed length: one
    partial sum a task, then a tree, so the driver adds up 64 vectors at most."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for b in batches:
            _, x = finite_rows(b.column(0), d)
            if len(x):
                s = of(x)
                total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([total.tobytes()], pa.binary())], names=["part", "s"])

    def fold(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_py()) for s in table.column("s"))
        return pa.table({"part": table.column("part").slice(0, 1), "s": pa.array([total.tobytes()], pa.binary())})

    sums = df.select(features_col).mapInArrow(partial, "part int, s binary")
    for groups in TREE:
        sums = sums.groupBy(F.col("part") % groups).applyInArrow(fold, "part int, s binary")
    found = [np.frombuffer(bytes(r.s)) for r in sums.orderBy(F.col("part") % TREE[-1]).collect()]
    if not found:
        raise ValueError("input is empty: no vectors")
    return np.sum(found, axis=0)


def fit_projection(df: DataFrame, features_col: str = "features", k: int = 2, tolerance: float = TOLERANCE,
                   max_rounds: int = MAX_ROUNDS) -> Projection:
    """Principal directions of the usable vectors (those of the most frequent
    length without NULL, NaN or infinite components). A pass over the rows for
    the mean and one a round; raises without a usable vector."""
    d = vector_dim(df, features_col)
    k = min(k, d)
    first = sum_over_rows(df, features_col, d, lambda x: np.append(x.sum(0), float(len(x))))
    n, mean = int(first[-1]), first[:-1] / first[-1]
    b = min(d, max(BLOCK, k + 2))
    block, _ = np.linalg.qr(np.random.default_rng(42).normal(size=(d, b)))
    basis, image = np.empty((d, 0)), np.empty((d, 0))
    values, components, residual, rounds = np.zeros(k), np.eye(d, k), 0.0, 0
    while rounds < max_rounds and block.shape[1]:
        def product(x: np.ndarray, q: np.ndarray = block) -> np.ndarray:
            x = x - mean
            return (x.T @ (x @ q)).ravel()

        more = sum_over_rows(df, features_col, d, product).reshape(d, -1) / max(n - 1, 1)
        rounds += 1
        basis, image = np.hstack([basis, block]), np.hstack([image, more])
        small = basis.T @ image
        e, z = np.linalg.eigh((small + small.T) / 2)
        values, z = e[::-1][:k], z[:, ::-1][:, :k]
        components = basis @ z
        off = np.linalg.norm(image @ z - components * values, axis=0)
        residual = float(off.max() / values[0]) if values[0] > 0 else 0.0
        if residual <= tolerance or basis.shape[1] >= d:
            break
        for _ in range(2):  # what is new in the products, orthogonal to all before
            more = more - basis @ (basis.T @ more)
        u, s, _ = np.linalg.svd(more, full_matrices=False)
        block = u[:, s > 1e-13 * max(values[0], 1e-300)][:, :d - basis.shape[1]]
        block = block - basis @ (basis.T @ block)
        block = np.linalg.qr(block)[0] if block.shape[1] else block
    return Projection(components, values, mean, n, rounds, residual)


def component_signs(model: Projection) -> np.ndarray:
    pc = model.components  # d x k
    top = np.argmax(np.abs(pc), axis=0)
    return np.where(pc[top, np.arange(pc.shape[1])] < 0, -1.0, 1.0)


def project_2d(df: DataFrame, features_col: str = "features", out_x: str = "x", out_y: str = "y",
               model: Projection | None = None) -> DataFrame:
    """Adds ``x, y``: the first two principal coordinates of the raw vectors, so
    their mean is that of the model's mean vector (one global fit over the usable
    vectors; NULL for the rest, and ``y`` for vectors of one component)."""
    model = model or fit_projection(df, features_col, 2)
    directions = model.components * component_signs(model)
    d, k = directions.shape

    @F.arrow_udf("array<double>")
    def coordinates(col: pa.Array) -> pa.Array:
        valid, x = finite_rows(col, d)
        flat = x @ directions
        if k < 2:
            flat = np.hstack([flat, np.full((len(flat), 1), np.nan)])
        rows: list = [None] * len(col)
        for i, r in zip(np.flatnonzero(valid).tolist(), flat.tolist(), strict=True):
            rows[i] = [v if v == v else None for v in r]
        return pa.array(rows, pa.list_(pa.float64()))

    c = "__xy"
    out = df.withColumn(c, coordinates(F.col(features_col)))
    return out.select(*df.columns, F.get(c, F.lit(0)).alias(out_x), F.get(c, F.lit(1)).alias(out_y))
