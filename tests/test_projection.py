"""The 2-D map: wide vectors, against numpy, on any partitioning."""

import resource

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow.operators import project


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "k int, features array<double>").repartition(parts)


def expected(x, k=2):
    _, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    comp = vt[:k].T
    return comp * np.where(comp[np.argmax(np.abs(comp), 0), range(comp.shape[1])] < 0, -1, 1), s[:k] ** 2 / (len(x) - 1)


@pytest.mark.parametrize("parts", [1, 7, 150])
def test_any_partitioning_gives_numpys_directions(spark, parts):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 90)) * np.linspace(3, 1, 90) + 5
    model = project.fit_projection(frame(spark, x, parts))
    comp, var = expected(x)
    assert np.allclose(model.components * project.component_signs(model), comp, atol=1e-7) and np.allclose(model.values, var)
    assert model.n == 300 and model.rounds <= 12 and np.allclose(model.mean, x.mean(0))


def test_vectors_as_wide_as_a_picture_models(spark):
    d = 20_480
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3)) @ (rng.normal(size=(3, d)) * [[3], [2], [1]]) + rng.normal(size=(60, d)) * 0.1
    df = frame(spark, x)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    model = project.fit_projection(df)
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
    comp, _ = expected(x)
    assert np.allclose(model.components * project.component_signs(model), comp, atol=1e-6)
    assert grown < 500  # MB; the d x d covariance alone would be 3,355
    got = project.project_2d(df, model=model).orderBy("k").select("x", "y").collect()
    assert np.allclose(np.array(got), x @ comp, atol=1e-4)


def test_flat_and_odd_inputs(spark):
    same = frame(spark, np.ones((5, 4)))
    model = project.fit_projection(same)
    assert np.allclose(model.values, 0) and model.components.shape == (4, 2)
    one = project.project_2d(frame(spark, np.arange(6.0)[:, None])).orderBy("k").collect()
    assert [r.x for r in one] == [0, 1, 2, 3, 4, 5] and {r.y for r in one} == {None}
    with pytest.raises(ValueError):
        project.fit_projection(same.limit(0))
    bad = spark.createDataFrame([(9, None), (8, [1.0]), (7, [1.0, None, 1.0, 1.0]), (6, [float("inf")] * 4)], same.schema)
    out = project.project_2d(same.unionByName(bad)).filter("k >= 6").select(F.col("x").isNull(), F.col("y").isNull()).collect()
    assert all(tuple(r) == (True, True) for r in out)
