"""Whitening of vectors by a bidiagonal qd solver.

Components come from the singular values of the centred rows, without forming
their covariance:

1. Sums and number of the different vectors, as whole numbers.
2. Blockwise QR: a task folds its centred rows into one triangle, batch by
   batch; triangles are stacked and folded eight at a time until one is left.
3. Householder reflections make that triangle bidiagonal.
4. dqds (Fernando and Parlett, 1994) finds the squared singular values, small
   ones to full relative accuracy too.
5. Twisted factorisations (Dhillon and Parlett, 2004) of the bidiagonal's
   product with itself, shifted by a squared singular value, give its vector:
   from the top and from the bottom to the row where they fit best. Vectors of
   values that lie closely together are made orthogonal to each other.

Steps 3 to 5 run in the task that folds the last triangle; what reaches the
driver are sums and ``components`` directions for each length of vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import Cuts, spare_name
from featureflow.llm.vectors import is_finite_vector

COMPONENTS, SCALE = 4, 256
FOLD = 8
EPS = float(np.finfo(float).eps)
CLOSE = 1e-3  # squared singular values nearer than this share of the greater one are a cluster
LARGEST = 2.0 ** 53


# ------------------------------------------------------------------ the bidiagonal solver

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right rotation of ``r`` = U B W', by Householder reflections."""
    a, d = r.astype(np.float64).copy(), r.shape[1]
    w = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if len(x) < 2 or size == 0 or not np.any(x[1:]):
            return None
        v = x / size
        v[0] += np.copysign(1.0, v[0])
        return v / np.linalg.norm(v)

    for j in range(d):
        v = reflector(a[j:, j])
        if v is not None:
            a[j:, j:] -= 2 * np.outer(v, v @ a[j:, j:])
        if j < d - 2:
            v = reflector(a[j, j + 1:])
            if v is not None:
                a[j:, j + 1:] -= 2 * np.outer(a[j:, j + 1:] @ v, v)
                w[:, j + 1:] -= 2 * np.outer(w[:, j + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, int]:
    """One shifted differential qd transform: new q, new e, smallest d and its place."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = low = q[0] - shift
    at = 0
    for i in range(n - 1):
        s = d + e[i]
        if s <= 0:  # the shift was too large, or nothing is left here
            if d < 0 or e[i] > 0 or s < 0:
                return new_q, new_e, min(low, d), at
            new_q[i], new_e[i], d = 0.0, 0.0, q[i + 1] - shift
        else:
            t = q[i + 1] / s
            new_q[i], new_e[i], d = s, e[i] * t, d * t - shift
        if d < low:
            low, at = d, i + 1
    new_q[n - 1] = d
    return new_q, new_e, low, at


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix by dqds, largest first."""
    out: list[float] = []
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    small = (10 * EPS) ** 2
    while todo:
        q, e, sigma = todo.pop()
        while q:
            if len(q) == 1:
                out.append(q.pop() + sigma)
                break
            if e[-1] <= small * (sigma + q[-1]):
                out.append(q.pop() + sigma)
                e.pop()
                continue
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= small * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:  # the small values belong at the end
                q.reverse()
                e.reverse()
            # the smaller value of the last two rows; the least one isn't above it
            a, c, b2 = q[-2], q[-1] + e[-1], q[-2] * e[-1]
            half = (a + c) / 2
            shift = max(0.0, (a * q[-1]) / (half + max(0.0, half * half - a * c + b2) ** 0.5) if half else 0.0) * (1 - 8 * EPS)
            for _ in range(30):
                new_q, new_e, low, at = dqds_step(q, e, shift)
                if low >= 0 or shift == 0:
                    break
                better = (shift + low) * (1 - 8 * EPS)
                shift = better if at == len(q) - 1 and 0 < better < shift else shift / 4 if shift > EPS * q[-1] else 0.0
            else:
                new_q, new_e, low, _ = dqds_step(q, e, 0.0)
                shift = 0.0
            q, e, sigma = [max(x, 0.0) for x in new_q], new_e, sigma + shift
    return np.sort(np.array(out))[::-1]


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float, rank: int = 0) -> tuple[np.ndarray, float]:
    """Unit vector z and correction of ``value`` from the twisted factorisation of
    B'B - ``value``; ``rank``: take the row that fits best (0), second best, ..."""
    n = len(diagonal)
    tiny = EPS * EPS * float(max(np.abs(diagonal).max(), np.abs(above).max() if n > 1 else 0.0)) or EPS
    a = [x if abs(x) > tiny else tiny for x in diagonal.tolist()]
    b = above.tolist()
    least = tiny * tiny
    down, up, s_of, p_of = [0.0] * (n - 1), [0.0] * (n - 1), [0.0] * n, [0.0] * n
    s = -value
    for i in range(n - 1):
        s_of[i] = s
        pivot = s + a[i] * a[i]
        pivot = pivot if abs(pivot) > least else -least
        down[i] = a[i] * b[i] / pivot
        s = down[i] * (b[i] / a[i]) * s - value
    s_of[n - 1] = s
    p = a[n - 1] * a[n - 1] - value
    p_of[n - 1] = p
    for i in range(n - 2, -1, -1):
        pivot = b[i] * b[i] + p
        pivot = pivot if abs(pivot) > least else -least
        t = a[i] * a[i] / pivot
        up[i] = a[i] * b[i] / pivot
        p = p * t - value
        p_of[i] = p
    gamma = np.array(s_of) + np.array(p_of) + value
    r = int(np.argsort(np.abs(gamma), kind="stable")[min(rank, n - 1)])
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    with np.errstate(over="ignore", invalid="ignore"):  # a row that fits badly: not taken
        size = float(np.linalg.norm(z))
        return np.nan_to_num(z / size), float(gamma[r]) / size / size


def inverse_iteration(diagonal: np.ndarray, above: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """Unit vector of B'B for a value that stands there several times, orthogonal
    to ``others``: for bidiagonals that fall apart, where one twist fits several vectors."""
    b = np.diag(diagonal) + np.diag(above, 1)
    shifted = b.T @ b - value * (1 + 16 * EPS) * np.eye(len(diagonal))
    z = np.random.default_rng(len(others)).normal(size=len(diagonal))
    for _ in range(4):
        for v in others * 2:
            z = z - v * (v @ z)
        z = np.linalg.lstsq(shifted, z / np.linalg.norm(z), rcond=EPS * EPS)[0]
    for v in others * 2:
        z = z - v * (v @ z)
    return z / np.linalg.norm(z)


def right_vectors(diagonal: np.ndarray, above: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest squared singular values and their right vectors (rows)."""
    n = len(diagonal)
    size = np.abs(diagonal)
    # parts without a link beyond rounding: vectors of their own
    cuts = np.flatnonzero(np.abs(above) <= 4 * EPS * np.maximum(size[:-1], size[1:])) + 1
    found: list[tuple[float, int, int]] = []
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), n], strict=True):
        found += [(float(v), a, b) for v in squared_singular_values(diagonal[a:b], above[a:b - 1])]
    found = sorted(found, key=lambda f: -f[0])[:k]
    values, vectors = np.zeros(len(found)), np.zeros((len(found), n))
    for i, (value, a, b) in enumerate(found):
        d, e = diagonal[a:b], above[a:b - 1]
        near = [j for j in range(i) if found[j][1] == a and abs(found[j][0] - value) <= CLOSE * found[j][0]]
        best, left = None, -1.0
        for rank in range(b - a):
            z, more = twisted(d, e, value, rank)
            for _ in range(3):  # Rayleigh corrections, while they are within rounding of the value
                if abs(more) <= EPS * value or abs(more) > 1e-6 * value:
                    break
                z, more = twisted(d, e, value + more, rank)
            for _ in range(2):
                for j in near:
                    z = z - vectors[j, a:b] * (vectors[j, a:b] @ z)
            size = float(np.linalg.norm(z)) if abs(more) <= 1e-9 * value else 0.0
            if size > left:
                best, left = z / size if size else z, size
            if left > 0.1 or rank == 2 * len(near):
                break
        if left <= 0.1 and value > 0:
            best = inverse_iteration(d, e, value, [vectors[j, a:b] for j in near])
        values[i], vectors[i, a:b] = value, best
    done = 0
    while done < len(found):  # clusters: the best basis of the vectors' span
        end = done + 1
        while end < len(found) and found[end - 1][0] - found[end][0] <= CLOSE * found[done][0]:
            end += 1
        if end - done > 1:
            basis, _ = np.linalg.qr(vectors[done:end].T)
            image = diagonal[:, None] * basis
            image[:-1] += above[:, None] * basis[1:]
            turn = np.linalg.svd(image, full_matrices=False)[2]
            vectors[done:end] = (basis @ turn.T).T
        done = end
    return values, vectors


def principal_directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest squared singular values of a triangle and the unit
    directions (rows). Values within rounding of 0 are 0."""
    diagonal, above, w = bidiagonal(r)
    values, z = right_vectors(diagonal, above, min(k, r.shape[1]))
    values = np.where(values > (8 * r.shape[1] * EPS) ** 2 * max(values[0], 0.0), values, 0.0)
    return values, z @ w.T


# ------------------------------------------------------------------ fitting on Spark

class Whitening(NamedTuple):
    """``scale``: rows that turn a centred vector into whitened coordinates (NaN
    where the variance is 0); ``values``: variances; ``identity_error``: how far
    the fit list's whitened covariance is from the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    scale: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])


def quantised(col: str, scale: int = SCALE) -> Column:
    """floor(scale * c) of each component, as whole numbers."""
    return F.transform(col, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))


def usable(col: str, scale: int = SCALE) -> Column:
    """A vector with components, none null or non-finite or beyond 2^53 when scaled."""
    return is_finite_vector(col) & F.coalesce(
        F.forall(col, lambda c: F.abs(F.lit(float(scale)) * c.cast("double")) < LARGEST), F.lit(False))


def by_length(batch: pa.RecordBatch, col: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, rows as whole numbers) of a batch."""
    column = batch.column(col)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield int(d), rows, flat.reshape(len(rows), int(d))


def exact_sums(fit_list: DataFrame, col: str) -> dict[int, tuple[int, list[int]]]:
    """Number and sums by length of vector. Components are summed in two halves,
    so that nothing overflows in a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(d, len(x), (x >> 32).sum(0).tolist(), (x & 0xFFFFFFFF).sum(0).tolist()) for d, _, x in by_length(batch, col)]
            names, kinds = ["d", "n", "high", "low"], [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in parts], t) for i, t in enumerate(kinds)], names=names)

    parts = fit_list.select(col).mapInArrow(run, "d int, n long, high array<long>, low array<long>")
    wide = "decimal(38,0)"
    sums = parts.select("d", "n", F.posexplode(F.arrays_zip("high", "low")).alias("i", "s")).groupBy("d", "i").agg(
        F.sum(F.col("n")).alias("n"), F.sum(F.col("s.high").cast(wide)).alias("high"), F.sum(F.col("s.low").cast(wide)).alias("low"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sums.orderBy("d", "i").collect():  # a row a dimension
        out.setdefault(r.d, (r.n, []))[1].append((int(r.high) << 32) + int(r.low))
    return out


def triangles(fit_list: DataFrame, col: str, means: dict[int, np.ndarray]) -> DataFrame:
    """``d, part, r``: for each task and length, the triangle of its centred rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in by_length(batch, col):
                rows = x - means[d]
                held[d] = np.linalg.qr(np.vstack([held[d], rows]) if d in held else rows, mode="r")
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([part] * len(held), pa.int64()),
             pa.array([r.tobytes() for r in held.values()], pa.binary())], names=["d", "part", "r"])

    return fit_list.select(col).mapInArrow(run, "d int, part long, r binary")


def fold(table: pa.Table) -> np.ndarray:
    d = table.column("d")[0].as_py()
    return np.linalg.qr(np.vstack([np.frombuffer(r.as_py()).reshape(-1, d) for r in table.column("r")]), mode="r")


def fold_some(table: pa.Table) -> pa.Table:
    part = table.column("part")[0].as_py() // FOLD
    return pa.table({"d": table.column("d").slice(0, 1), "part": pa.array([part], pa.int64()),
                     "r": pa.array([fold(table).tobytes()], pa.binary())})


def solve(folded: DataFrame, k: int) -> DataFrame:
    """``d, value, direction, total`` by falling value, from the last triangles of each length."""
    def last(table: pa.Table) -> pa.Table:
        r = fold(table)
        d = r.shape[1]
        values, directions = principal_directions(np.vstack([r, np.zeros((max(0, d - len(r)), d))]), k)
        return pa.table({"d": pa.array([d] * len(values), pa.int32()), "value": pa.array(values, pa.float64()),
                         "direction": pa.array([v.tolist() for v in directions], pa.list_(pa.float64())),
                         "total": pa.array([float((r * r).sum())] * len(values), pa.float64())})

    return folded.groupBy("d").applyInArrow(last, "d int, value double, direction array<double>, total double")


def moments(fit_list: DataFrame, col: str, models: dict[int, Whitening]) -> dict[int, float | None]:
    """Largest entry of the whitened covariance minus the identity, by length:
    sums of products over the fit list, added up on Spark."""
    plans = {d: (m.mean, m.scale[~np.isnan(m.scale).any(axis=1)]) for d, m in models.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for d, _, x in by_length(batch, col):
                mean, scale = plans[d]
                if len(scale):
                    w = (x - mean) @ scale.T
                    found.append((d, [*w.sum(0).tolist(), *(w.T @ w).ravel().tolist()]))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()),
                                              pa.array([f[1] for f in found], pa.list_(pa.float64()))], names=["d", "s"])

    sums: dict[int, list[float]] = {}
    parts = fit_list.select(col).mapInArrow(run, "d int, s array<double>")
    for r in parts.select("d", F.posexplode("s").alias("i", "s")).groupBy("d", "i").agg(
            F.sum("s").alias("s")).orderBy("d", "i").collect():  # k + k * k rows a length
        sums.setdefault(r.d, []).append(r.s)
    out: dict[int, float | None] = {}
    for d, m in models.items():
        k = len(plans[d][1])
        if k:
            s = np.array(sums[d]) / m.n
            out[d] = float(np.abs(s[k:].reshape(k, k) - np.outer(s[:k], s[:k]) - np.eye(k)).max())
        else:
            out[d] = None
    return out


def fit(vectors: DataFrame, cuts: Cuts, col: str, components: int = COMPONENTS) -> dict[int, Whitening]:
    """Whitening by length of vector, fitted on each different vector of whole
    numbers once. No vectors: no models."""
    fit_list = cuts.save(vectors.select(col).distinct(), keep=False)
    sums = exact_sums(fit_list, col)
    if not sums:
        return {}
    means = {d: np.array([float(Fraction(s, n)) for s in total]) for d, (n, total) in sums.items()}
    folded = cuts.save(triangles(fit_list, col, means), keep=False)
    parts = folded.count()
    while parts > FOLD * len(sums):
        folded = cuts.save(folded.groupBy("d", F.expr(f"part div {FOLD}")).applyInArrow(
            fold_some, "d int, part long, r binary"), keep=False)
        fewer = folded.count()
        if fewer >= parts:
            break
        parts = fewer
    models: dict[int, Whitening] = {}
    solved: dict[int, list] = {}
    for r in solve(folded, components).collect():  # ``components`` rows a length
        solved.setdefault(r.d, []).append(r)
    for d, rows in solved.items():
        n, total = sums[d]
        values = np.array([r.value for r in rows]) / n
        directions = np.array([r.direction for r in rows])
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(values[:, None] > 0, directions / np.sqrt(values)[:, None], np.nan)
        models[d] = Whitening(n, total, values, scale, rows[0].total / n)
    errors = moments(fit_list, col, models)
    return {d: m._replace(identity_error=errors[d]) for d, m in models.items()}


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - sum)^2 over a row's components, exact; None beyond a long."""
    most = max(int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0), 1)
    if most * most * max(x.shape[1], 1) < 2 ** 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    found = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 2 ** 63 else None for v in found]


def whiten(vectors: DataFrame, cuts: Cuts, vector_col: str = "embedding", scale: int = SCALE,
           components: int = COMPONENTS) -> DataFrame:
    """The usable rows of ``vectors`` with ``whitened`` (coordinates on up to
    ``components`` principal directions, variance 1 over the fit list), ``fit_n``
    (its vectors), ``deviation`` (fit_n^2 times the squared distance from its
    mean, exact), ``explained`` (share of the variance, by component) and
    ``identity_error``.

    A component c counts as floor(``scale`` * c). Rows whose vector is null, empty
    or holds null, non-finite or too large components (beyond 2^53 when scaled)
    go. Vectors of each length are whitened on their own. Equal vectors count
    once in the fit and all stay in the result. A direction without variance
    (all vectors alike, fewer vectors than directions) has null coordinates and
    explains 0; without any, ``identity_error`` is null. ``deviation`` is null
    where a long can't hold it. Other columns pass through; columns already
    called so are replaced. An empty table gives an empty table."""
    names = ["whitened", "fit_n", "deviation", "explained", "identity_error"]
    vectors = vectors.drop(*names)
    x = spare_name(vectors, "whole_")
    rows = vectors.filter(usable(vector_col, scale)).withColumn(x, quantised(vector_col, scale))
    models = fit(rows, cuts, x, components)
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([*vectors.schema.fields, *[T.StructField(c, t) for c, t in zip(
        names, [doubles, T.LongType(), T.LongType(), doubles, T.DoubleType()], strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, whole in by_length(batch, x):
                m = models[d]
                w = (whole - m.mean) @ np.nan_to_num(m.scale).T
                known = ~np.isnan(m.scale).any(axis=1)
                flat = pa.array(w.ravel(), mask=~np.tile(known, len(w)))
                offsets = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
                share = (m.values / m.trace).tolist() if m.trace > 0 else [0.0] * len(m.values)
                yield pa.RecordBatch.from_arrays(
                    [*batch.take(pa.array(at)).columns[:-1], pa.ListArray.from_arrays(offsets, flat),
                     pa.array([m.n] * len(w), pa.int64()), pa.array(deviations(whole, m.n, m.sums), pa.int64()),
                     pa.array([share] * len(w), pa.list_(pa.float64())),
                     pa.array([m.identity_error] * len(w), pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)
