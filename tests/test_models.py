import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow.operators import classify, cluster, columns, evaluate, project, splits

EMB = "/root/testdata/sf0.01/embeddings.parquet"


def _emb(spark):
    return spark.read.parquet(EMB)


def test_nearest_centroid_equals_numpy(spark):
    emb = splits.hash_split(_emb(spark), "vec_id")
    pdf = emb.toPandas()
    x = np.stack(pdf.embedding.map(lambda v: np.asarray(v, np.float64)))
    tr = (pdf.split == "train").to_numpy()
    labels = sorted(set(pdf.label[tr]))
    cents = np.stack([x[tr & (pdf.label == c).to_numpy()].mean(0) for c in labels])
    d = ((x[:, None, :] - cents[None]) ** 2).sum(-1)
    want = dict(zip(pdf.vec_id, np.array(labels)[np.argmin(np.round(d, 9), 1)]))
    model = classify.fit_centroids(emb.filter("split = 'train'"), "embedding")
    assert model.labels == labels
    assert np.allclose(model.centers, cents, atol=1e-12)
    got = {r.vec_id: r.prediction for r in model.transform(emb, "embedding").collect()}
    assert got == want


def test_centroid_scores_bad_rows_as_null(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 0.8])], "label int, features array<float>")
    model = classify.fit_centroids(df)
    test = spark.createDataFrame([(1, [0.9, 0.9]), (2, None), (3, [1.0])], "id int, features array<float>")
    rows = {r.id: r for r in model.transform(test, distance_col="d").collect()}
    assert rows[1].prediction == 1 and rows[2].prediction is None and rows[3].prediction is None
    assert abs(sum(rows[1].probability) - 1) < 1e-12


def test_empty_training_raises(spark):
    empty = _emb(spark).filter("vec_id < 0")
    with pytest.raises(ValueError):
        classify.fit_centroids(empty, "embedding")
    with pytest.raises(ValueError):
        classify.train_forest(empty, "embedding")
    with pytest.raises(ValueError):
        classify.train_mlp(empty, "embedding")


def test_forest_and_mlp_learn(spark):
    emb = _emb(spark)
    rf = classify.train_forest(emb, "embedding", num_trees=10)
    acc = evaluate.accuracy_f1(classify.predict(rf, emb, "embedding")).first().accuracy
    assert acc > 0.5
    mlp = classify.train_mlp(emb, "embedding", hidden=(32,), max_iter=50)
    pred = classify.predict(mlp, emb, "embedding")
    assert dict(pred.dtypes)["prediction"] == "int"
    assert evaluate.accuracy_f1(pred).first().accuracy > 0.3


def test_kmeans_and_lloyd(spark):
    emb = _emb(spark)
    out, model = cluster.kmeans(emb, 5, 42, "embedding")
    assert out.select("cluster").distinct().count() == 5
    init = cluster.init_centroids(emb, 5, "vec_id", "embedding")
    assigned = cluster.assign_centroids(emb, init, "embedding")
    assert assigned.filter("vec_id < 5").select(F.max("distance")).first()[0] == 0.0
    step = cluster.lloyd_step(assigned, "embedding", "cluster")
    assert step.agg(F.sum("n")).first()[0] == 500


def test_projection_equals_numpy_pca(spark):
    emb = _emb(spark)
    got = project.project_2d(emb, "embedding").orderBy("vec_id").toPandas()
    pdf = emb.orderBy("vec_id").toPandas()
    x = np.stack(pdf.embedding.map(lambda v: np.asarray(v, np.float64)))
    xc = x - x.mean(0)
    _, _, vt = np.linalg.svd(xc, full_matrices=False)
    comp = vt[:2].T
    comp *= np.where(comp[np.argmax(np.abs(comp), 0), [0, 1]] < 0, -1, 1)
    # Spark ML's PCA projects the raw (uncentred) vectors
    want = x @ comp
    assert np.allclose(got[["x", "y"]].to_numpy(), want, atol=1e-6)


def test_fit_centroids_checks_matrix_bytes(spark):
    df = spark.createDataFrame([(i % 3, [float(i)] * 100) for i in range(30)], "label int, features array<float>")
    assert classify.fit_centroids(df).centers.shape == (3, 100)
    with pytest.raises(ValueError, match="exceeds"):
        classify.fit_centroids(df, max_bytes=3 * 100 * 8 - 1)


def test_bad_vectors_get_null_outputs(spark):
    rows = [(i, i % 2, [float(i % 2) * 5 + (i % 7) * 0.1, float(i % 5)]) for i in range(60)]
    bad = [(100, 0, None), (101, 1, [1.0]), (102, 1, [1.0, None]), (103, 0, [float("nan"), 1.0])]
    df = spark.createDataFrame(rows + bad, "k int, label int, features array<double>")
    out, _ = cluster.kmeans(df, 2)
    checks = {"kmeans": out.select("k", F.col("cluster").alias("v")),
              "project": project.project_2d(df).select("k", F.col("x").alias("v"))}
    for name, model in (("forest", classify.train_forest(df, num_trees=3)), ("mlp", classify.train_mlp(df, hidden=(4,), max_iter=5))):
        checks[name] = classify.predict(model, df).select("k", F.col("prediction").alias("v"))
    checks["centroid"] = classify.fit_centroids(df).transform(df).select("k", F.col("prediction").alias("v"))
    for name, got in checks.items():
        missing = {r.k for r in got.collect() if r.v is None}
        assert missing == {100, 101, 102, 103}, name
    assert {r.k for r in columns.with_vector_status(df).filter("status = 'bad_vector'").collect()} == {100, 101, 102, 103}


def test_rows_matrix_reads_arrow_lists():
    import pyarrow as pa

    from featureflow.operators.arrow import rows_matrix as _rows_matrix

    arr = pa.array([[1.0, 2.0], None, [3.0], [4.0, 5.0], [6.0, None]], type=pa.list_(pa.float32()))
    valid, x = _rows_matrix(arr, 2)
    assert valid.tolist() == [True, False, False, True, True]
    assert np.allclose(x[:2], [[1, 2], [4, 5]]) and x[2, 0] == 6 and np.isnan(x[2, 1])
    valid, x = _rows_matrix(arr.slice(3, 2), 2)  # a slice keeps its offsets into the full child array
    assert valid.tolist() == [True, True] and x[0].tolist() == [4.0, 5.0]
    valid, x = _rows_matrix(pa.array([None], type=pa.list_(pa.float64())), 3)
    assert valid.tolist() == [False] and x.shape == (0, 3)


def test_centroid_scores_odd_rows_as_null(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [4.0, 4.0])], "label int, features array<double>")
    model = classify.fit_centroids(df)
    odd = spark.createDataFrame([(1, None), (2, [1.0]), (3, [3.5, 3.0])], "id int, features array<double>")
    rows = {r.id: r for r in model.transform(odd, distance_col="distance").collect()}
    assert rows[1].prediction is None and rows[1].probability is None and rows[1].distance is None
    assert rows[2].prediction is None
    assert rows[3].prediction == 1 and abs(sum(rows[3].probability) - 1) < 1e-12 and rows[3].distance == 1.25


def _blobs(spark, n=240, parts=3):
    rng = np.random.default_rng(5)
    at = np.array([[0, 0], [30, 0], [0, 30], [30, 30]], float)
    rows = [(i, [float(v) for v in at[i % 4] + rng.normal(0, 1, 2)]) for i in range(n)]
    return spark.createDataFrame(rows, "vec_id long, features array<double>").repartition(parts)


def test_parallel_start_same_on_any_partitioning(spark):
    one = cluster.parallel_start(_blobs(spark, parts=1), 4, "vec_id").centers
    many = cluster.parallel_start(_blobs(spark, parts=7), 4, "vec_id").centers
    assert np.array_equal(one, many)
    # a centre in each of the four clouds
    assert sorted(tuple(c) for c in (one > 15).tolist()) == [(False, False), (False, True), (True, False), (True, True)]
    other = cluster.parallel_start(_blobs(spark), 4, "vec_id", seed=7).centers
    assert not np.array_equal(one, other)


def test_parallel_start_copies_bad_rows_and_repeated_keys(spark):
    rows = [(1, [0.0, 0.0])] * 80 + [(i, [0.0, 0.0]) for i in range(100, 160)] + [(200, [5.0, 5.0]), (201, [9.0, 0.0])]
    rows += [(202, None), (203, [1.0]), (None, [7.0, 7.0]), (204, [float("nan"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, features array<double>")
    got = cluster.parallel_start(df, 3, "vec_id").centers
    assert sorted(map(tuple, got.tolist())) == [(0.0, 0.0), (5.0, 5.0), (9.0, 0.0)]
    with pytest.raises(ValueError, match="different vectors"):
        cluster.parallel_start(df, 4, "vec_id")
    # one key with many vectors: its draws go together, what reaches the driver stays bounded
    hot = spark.createDataFrame([(1, [float(i), 0.0]) for i in range(500)], "vec_id long, features array<double>")
    assert cluster.parallel_start(hot, 3, "vec_id").centers.shape == (3, 2)
