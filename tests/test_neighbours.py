"""The neighbour graph: recall against all distances, any partitioning, odd rows."""

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from featureflow.operators import neighbours as nm


def test_graph_recall(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding")
    x = np.array([r.embedding for r in emb.orderBy("vec_id").collect()], np.float64)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    got = {}
    for r in nm.neighbour_graph(emb, "vec_id", "embedding", k=10).collect():
        assert r.dist == pytest.approx(d[r.i, r.j])
        got.setdefault(r.i, set()).add(r.j)
    true = np.argsort(d, axis=1)[:, :10]
    assert all(len(got[i]) == 10 for i in range(len(x)))
    assert sum(len(got[i] & set(true[i].tolist())) for i in range(len(x))) / (10 * len(x)) > 0.9


def test_same_graph_on_any_partitioning_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(v) for v in rng.normal(size=6) + 8 * (i % 3)]) for i in range(90)]
    rows += [(200, rows[0][1]), (201, rows[0][1])]
    bad = [(None, rows[0][1]), (300, None), (301, [1.0]), (302, [float("nan")] * 6)]
    df = spark.createDataFrame(rows + bad, "sample_id long, features array<double>")
    one, six = (sorted(tuple(r) for r in nm.neighbour_graph(df.repartition(p), k=5, directions=2, descents=1).collect()) for p in (1, 6))
    assert one == six and len(one) == 5 * len(rows)
    with pytest.raises(ValueError):
        nm.neighbour_graph(df.unionByName(df.filter("sample_id = 5")))
    few = nm.neighbour_graph(df.filter("sample_id < 4"), k=5, directions=1, descents=1).groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    assert sorted((r.i, r.n) for r in few.collect()) == [(0, 3), (1, 3), (2, 3), (3, 3)]
