"""Whitening against numpy's eigenvectors, and its solver on awkward matrices."""

import numpy as np
import pytest
from conftest import SF01

from featureflow.llm.common import Cuts
from featureflow.llm.queries import queries
from featureflow.llm.whitening import bidiagonal, deviations, principal_directions, squared_singular_values, whiten


def matrices():
    rng = np.random.default_rng(4)
    for t in range(160):
        n, d = int(rng.integers(1, 70)), int(rng.integers(1, 33))
        x = rng.normal(size=(n, d))
        yield [x, x * 10.0 ** rng.integers(-8, 8, size=d), np.round(x), x * (np.arange(d) % 3 > 0),
               np.eye(d)[rng.integers(0, d, size=n)], x * 0, np.vstack([np.eye(d), -np.eye(d)]),
               np.diag(np.r_[np.ones(d - d // 2), np.ones(d // 2) * (1 + 1e-9)])][t % 8]


def test_solver_on_random_graded_and_repeated_values():
    for x in matrices():
        d = x.shape[1]
        r = np.linalg.qr(x, mode="r")
        r = np.vstack([r, np.zeros((max(0, d - len(r)), d))])
        a, b, w = bidiagonal(r)
        assert np.abs(w.T @ w - np.eye(d)).max() < 1e-12
        true = np.linalg.svd(r, compute_uv=False)
        got = squared_singular_values(a, b)
        assert len(got) == d and np.abs(np.sqrt(np.maximum(got, 0)) - true).max() <= 1e-12 * max(true[0], 1e-300)
        value, v = principal_directions(r, 4)
        value, v = value[value > 0], v[value > 0]
        if len(value):
            assert np.abs(v @ v.T - np.eye(len(v))).max() < 1e-10
            assert np.linalg.norm(r.T @ (r @ v.T) - v.T * value, axis=0).max() < 1e-12 * true[0] ** 2


def test_dqds_keeps_small_values_accurate():
    a = 10.0 ** -np.arange(0, 24, 2.0)
    b = a[:-1] * 0.5
    got = np.sqrt(squared_singular_values(a, b))
    # the product of all singular values is that of the diagonal, whatever their sizes
    assert abs(np.log(got).sum() - np.log(a).sum()) < 1e-12
    assert got[-1] < 1e-20 and abs(got[-1] / a[-1] - 1) < 0.5


def expected(vectors, scale=256, k=4):
    """numpy's version for rows (id, vector) of one length."""
    x = {i: np.floor(scale * np.array(v, np.float64)).astype(np.int64) for i, v in vectors}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, {i: ((n * q - s) ** 2).sum() for i, q in x.items()}, {i: (q - s / n) @ v / np.sqrt(e) for i, q in x.items()}, e / np.trace(c.T @ c / n)


def test_query_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    n, deviation, white, share = expected(rows)
    got = queries()["op11_whitening"](spark, SF01).collect()
    assert len(got) == 4 * len(rows)
    sign = {}
    for r in got:
        true = white[r.vec_id][r.component - 1]
        if r.component not in sign and abs(true) > 1e-3:
            sign[r.component] = np.sign(true * r.whitened)
        assert (r.n, r.deviation) == (n, deviation[r.vec_id])
        assert abs(r.whitened * sign.get(r.component, 1) - true) < 1e-9
        assert abs(r.explained - share[r.component - 1]) < 1e-9
        assert r.identity_error < 1e-9


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string, whole_ int, d string")


def test_awkward_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(c) for c in rng.normal(size=5)]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5), (104, []),
           (105, [1e30] * 5)]
    copies = [(None, good[0][1])] + [(200 + i, good[1][1]) for i in range(30)]
    others = [(300, [1.0, 2.0]), (301, [1.0, 2.0]), (302, [-1.0, 0.0]), (303, [7.0])]
    rows = good + bad + copies + others
    df = table(spark, [(i, v, "x", 1, "y") for i, v in rows]).repartition(7)
    with Cuts(spark) as cuts:
        got = whiten(df, cuts).collect()
    assert len(got) == len(good) + len(copies) + len(others)
    n, deviation, white, _ = expected(good)
    by_id = {r.vec_id: r for r in got}
    for i, _ in good:
        assert by_id[i].fit_n == n == 40 and by_id[i].deviation == deviation[i] and by_id[i].whole_ == 1
        assert np.allclose(np.abs(by_id[i].whitened), np.abs(white[i]), atol=1e-9)
    assert by_id[None].whitened == by_id[0].whitened
    two = by_id[300]
    assert two.fit_n == 2 and abs(abs(two.whitened[0]) - 1) < 1e-9 and two.whitened[1] is None
    assert two.explained[0] == pytest.approx(1.0) and two.explained[1] == 0 and two.identity_error < 1e-9
    one = by_id[303]
    assert (one.fit_n, one.deviation, one.whitened, one.explained, one.identity_error) == (1, 0, [None], [0.0], None)


def test_empty_tables_and_wide_integers(spark):
    with Cuts(spark) as cuts:
        assert whiten(table(spark, []), cuts).collect() == []
        assert whiten(table(spark, [(1, None, "", 0, "")]), cuts).collect() == []
    x = np.array([[2 ** 40, -2 ** 41], [5, 6]], np.int64)
    n, sums = 2 ** 20, [3, 4]
    assert deviations(x, n, sums) == [None, sum((n * v - s) ** 2 for v, s in zip([5, 6], sums, strict=True))]


def test_many_partitions_fold_to_one_triangle(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=6)], "", 0, "") for i in range(600)]
    own = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "2000",
           "spark.sql.shuffle.partitions": "90"}
    old = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        with Cuts(spark) as cuts:
            got = whiten(table(spark, rows).repartition(40), cuts).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    _, _, white, _ = expected([(r[0], r[1]) for r in rows])
    assert all(np.allclose(np.abs(r.whitened), np.abs(white[r.vec_id]), atol=1e-9) for r in got)
