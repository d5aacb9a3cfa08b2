import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow import sinks
from featureflow.sources.labels import read_labels
from featureflow.sources.manifest import read_manifest
from featureflow.sources.samples import read_samples, require_dim
from featureflow.sources.vectors import read_vector_files

HEADER = "name\timage_id\tface_id\turl\tbbox\tsha256\n"


def test_manifest_fixed_schema_and_missing_file(spark, tmp):
    a = os.path.join(tmp, "actors.txt")
    with open(a, "w") as f:
        f.write(HEADER)
        f.write("Ann Example\t12\t7\thttp://h/a.jpg\t10,20,110,140\t00ff\n")
        f.write("Ann Example\tx1\t8\thttp://h/b.jpg\t1,2,3\t00fe\n")
        f.write("Bob\t\t9\thttp://h/c.jpg\t\t00fd\n")
        f.write("Short\t5\n")
    df = read_manifest(spark, [a, os.path.join(tmp, "missing.txt")], with_source=True)
    rows = df.orderBy(F.col("face_id").asc_nulls_last()).collect()
    assert [r.image_id for r in rows] == [12, None, None, 5]
    assert rows[3].url is None and rows[0].source_file.endswith("actors.txt")
    with pytest.raises(FileNotFoundError):
        read_manifest(spark, [os.path.join(tmp, "missing.txt")], missing="error")
    assert read_manifest(spark, [os.path.join(tmp, "missing.txt")]).count() == 0
    flagged = {r.face_id: r.status for r in read_manifest(spark, a, malformed="flag").collect()}
    assert flagged == {"7": "ok", "8": "ok", "9": "ok", None: "malformed"}
    assert read_manifest(spark, a, malformed="drop").count() == 3


def test_labels_without_error_key(spark, tmp):
    p = os.path.join(tmp, "labels.json")
    with open(p, "w") as f:
        json.dump([{"image_path": "data/raw/images/Ann/12.jpg", "emotion": "happy"},
                   {"image_path": "data/raw/images/Ann/13.jpg", "emotion": "sad"}], f)
    df = read_labels(spark, p)
    assert df.columns == ["image_path", "emotion", "error"]
    assert df.filter(F.col("error").isNull()).count() == 2


def test_vector_files(spark, tmp):
    root = os.path.join(tmp, "features")
    os.makedirs(os.path.join(root, "Ann"))
    os.makedirs(os.path.join(root, "Bob"))
    np.save(os.path.join(root, "Ann", "12.npy"), np.arange(4, dtype=np.float32))
    np.save(os.path.join(root, "Ann", "13.npy"), np.array([], dtype=np.float32))
    np.save(os.path.join(root, "Bob", "1.npy"), np.array(["a", "b"]))
    np.save(os.path.join(root, "Bob", "2.npy"), np.arange(6, dtype=np.float64))
    np.save(os.path.join(root, "Bob", ".3.npy"), np.arange(4, dtype=np.float32))
    with open(os.path.join(root, "Bob", "4.npy"), "wb") as f:
        f.write(b"junk")
    rows = {(r.person, r.image_id): r for r in read_vector_files(spark, root).collect()}
    assert set(rows) == {("Ann", 12), ("Ann", 13), ("Bob", 1), ("Bob", 2), ("Bob", 4)}
    assert rows[("Ann", 12)].features == [0.0, 1.0, 2.0, 3.0] and rows[("Ann", 12)].status == "ok"
    assert rows[("Ann", 13)].status == "empty" and rows[("Bob", 1)].status == "not_numeric"
    assert rows[("Bob", 4)].status.startswith("unreadable")
    checked = {(r.person, r.image_id): r.status for r in require_dim(read_vector_files(spark, root), 4).collect()}
    assert checked[("Bob", 2)] == "bad_dim" and checked[("Ann", 12)] == "ok"


def test_samples_roundtrip_and_pruning(spark, tmp):
    df = spark.createDataFrame([(i, i % 3, [float(i)], ["train", "val", "test"][i % 3]) for i in range(30)],
                               "sample_id bigint, label int, features array<float>, split string")
    path = os.path.join(tmp, "samples")
    sinks.write_samples(df, path, max_records=4)
    names = set(os.listdir(path))
    assert {"_SUCCESS", "split=test", "split=train", "split=val"} <= names
    assert all(len([f for f in os.listdir(os.path.join(path, "split=train")) if f.endswith(".parquet")]) >= 3
               for _ in [0])  # 10 rows, at most 4 per file
    back = read_samples(spark, path)
    assert back.count() == 30
    tr = back.filter("split = 'train'")
    assert tr.count() == 10
    plan = tr._jdf.queryExecution().executedPlan().toString()
    import re

    assert re.search(r"PartitionFilters: \[[^\]]*split", plan)


def test_write_table_formats(spark, tmp):
    df = spark.createDataFrame([("a.npy", 1, 0.5)], "filename string, cluster int, x double")
    sinks.write_table(df, os.path.join(tmp, "c"), "csv", columns=["filename", "cluster"])
    back = spark.read.option("header", True).csv(os.path.join(tmp, "c"))
    assert back.columns == ["filename", "cluster"] and back.first().cluster == "1"
    sinks.write_table(df, os.path.join(tmp, "j"), "json")
    assert spark.read.json(os.path.join(tmp, "j")).first().x == 0.5
    with pytest.raises(ValueError):
        sinks.write_table(df, os.path.join(tmp, "z"), "xml")


def test_models_persist(spark, tmp):
    from pyspark.ml.classification import RandomForestClassificationModel

    from featureflow.operators import classify

    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    cm = classify.fit_centroids(emb, "embedding")
    sinks.save_model(cm, os.path.join(tmp, "cm"))
    cm2 = sinks.load_model("centroids", os.path.join(tmp, "cm"))
    assert cm2.labels == cm.labels and np.allclose(cm2.centers, cm.centers)
    rf = classify.train_forest(emb, "embedding", num_trees=3)
    sinks.save_model(rf, os.path.join(tmp, "rf"))
    rf2 = sinks.load_model(RandomForestClassificationModel, os.path.join(tmp, "rf"))
    assert rf2.getNumTrees == 3
    hist = spark.createDataFrame([("r", 0, "train", "accuracy", 0.5)], "run_id string, step int, split string, metric string, value double")
    sinks.append_metrics(hist, os.path.join(tmp, "m"))
    sinks.append_metrics(hist, os.path.join(tmp, "m"))
    assert sinks.read_metrics(spark, os.path.join(tmp, "m")).collect() == hist.collect()  # a retry replaces its rows
    sinks.append_metrics(hist.withColumn("step", F.lit(1)), os.path.join(tmp, "m"))
    assert sorted(r.step for r in sinks.read_metrics(spark, os.path.join(tmp, "m")).collect()) == [0, 1]
