"""The data-parallel network against a single-process run on the same batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow.operators import network as net


def rows_of(spark, n=300, d=6, k=3):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, d)).astype(np.float32)
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int) + (x[:, 2] > 1)
    return spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))],
                                 "id long, features array<float>, label int")


def test_gradient_by_differences():
    rng, dims = np.random.default_rng(0), [4, 5, 3]
    flat, x, y = net.first_weights(dims, 1), rng.normal(size=(7, 4)), rng.integers(0, 3, 7)
    _, grad = net.loss_and_gradient(flat, dims, x, y)
    for i in range(0, len(flat), 3):
        a, b = flat.copy(), flat.copy()
        a[i], b[i] = a[i] + 1e-6, b[i] - 1e-6
        diff = (net.loss_and_gradient(a, dims, x, y)[0] - net.loss_and_gradient(b, dims, x, y)[0]) / 7 / 2e-6
        assert abs(diff - grad[i]) < 1e-5


def test_equal_to_one_process(spark, tmp):
    df = rows_of(spark)
    hidden, epochs, size, shards, seed = (16, 8), 3, 32, 4, 7
    got = net.train_network(df, hidden=hidden, epochs=epochs, batch_size=size, shards=shards, seed=seed, folder=tmp + "/a",
                            key=["id"])
    dims = [6, *hidden, 3]
    state, losses = (net.first_weights(dims, seed), np.zeros(net.sizes_of(dims)), np.zeros(net.sizes_of(dims)), 0), []
    for epoch in range(1, epochs + 1):
        order = F.xxhash64(F.lit(seed), F.lit(epoch), "label", "features", F.xxhash64("id"))
        rows = df.select("features", "label", order.alias("o")).withColumn("s", F.pmod(F.shiftright("o", 8), F.lit(shards))).collect()
        ends, total = [], 0.0
        for s in range(shards):
            own = sorted([r for r in rows if r.s == s], key=lambda r: r.o)
            x, y = np.array([r.features for r in own]), np.array([r.label for r in own])
            a = net.Adam(*state, 0.001)
            for at in range(0, len(own), size):
                loss, grad = net.loss_and_gradient(a.flat, dims, x[at:at + size], y[at:at + size])
                a.step(grad)
                total += loss
            ends.append((len(own) / len(rows), a))
        state = tuple(sum(p * getattr(a, f) for p, a in ends) for f in ("flat", "m", "v")) + (max(a.steps for _, a in ends),)
        losses.append(total / len(rows))
    assert np.allclose(got.flat, state[0], atol=1e-9) and np.allclose(got.losses, losses, atol=1e-9)
    # any partitioning gives the same network; a stopped training goes on
    other = net.train_network(df.repartition(7), hidden=hidden, epochs=2, batch_size=size, shards=shards, seed=seed, folder=tmp + "/b",
                              key=["id"])
    other = net.train_network(df.repartition(3), hidden=hidden, epochs=3, batch_size=size, shards=shards, seed=seed, folder=tmp + "/b",
                              key=["id"])
    assert np.allclose(got.flat, other.flat, atol=1e-12)
    assert np.allclose(got.at(spark, 2).flat, other.at(spark, 2).flat, atol=1e-12)
    p = got.transform(df.unionByName(spark.createDataFrame([(-1, None, 0), (-2, [1.0], 0)], df.schema))).collect()
    for r in p:
        if r.id < 0:
            assert r.prediction is None and r.probability is None
        else:
            want = net.forward(got.flat, dims, np.array([r.features]))[-1][0]
            assert np.allclose(r.probability, want) and r.prediction == int(np.argmax(want))


def test_bad_input(spark):
    df = rows_of(spark, 10)
    with pytest.raises(ValueError):
        net.train_network(df.limit(0))
    with pytest.raises(ValueError):
        net.train_network(df.withColumn("label", F.lit(-1)))


def test_forest_steps_by_brute_force(spark):
    from featureflow.operators import classify, evaluate

    df = rows_of(spark).withColumn("split", F.lit("train"))
    model = classify.train_forest(df, num_trees=6, max_depth=3)
    got = {(r.id, r.step): r for r in classify.forest_steps(model, df).collect()}
    shares = [{r.id: r.probability for r in classify.predict(t, df).collect()} for t in model.trees]
    whole = {r.id: r for r in classify.predict(model, df).collect()}
    assert len(got) == 300 * 6
    for (i, t), r in got.items():
        want = np.mean([s[i] for s in shares[:t]], axis=0)
        assert np.allclose(r.probability, want, atol=1e-12) and abs(want[r.prediction] - want.max()) < 1e-12
        if t == 6:
            assert np.allclose(r.probability, whole[i].probability) and r.prediction == whole[i].prediction
    hist = evaluate.evaluate_splits(classify.forest_steps(model, df), step_col="step").collect()
    assert {(r.step, r.metric) for r in hist} == {(t, m) for t in range(1, 7) for m in ("accuracy", "f1", "loss")}
    for r in hist:
        if r.metric == "accuracy":
            right = np.mean([got[i, r.step].prediction == whole[i].label for i in range(300)])
            assert abs(r.value - right) < 1e-12
    bad = spark.createDataFrame([(1, None, 0, "x")], df.schema)
    assert {r.prediction for r in classify.forest_steps(model, bad).collect()} == {None}
