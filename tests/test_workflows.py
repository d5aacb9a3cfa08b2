"""End to end on generated pictures, a TSV manifest and a JSON label file."""

import json
import os

import numpy as np
import pytest
from conftest import write_png
from pyspark.sql import functions as F

from featureflow.plans import workflows

HEADER = "name\timage_id\tface_id\turl\tbbox\tsha256\n"
PEOPLE = ["Ann Example", "Bob Builder", "Cy"]
EMOTIONS = ["happy", "sad", "angry", "fear"]


@pytest.fixture()
def layout(tmp):
    rng = np.random.default_rng(7)
    images = os.path.join(tmp, "raw")
    manifest = os.path.join(tmp, "actors.txt")
    labels = []
    with open(manifest, "w") as f:
        f.write(HEADER)
        for p_i, person in enumerate(PEOPLE):
            folder = person.replace(" ", "_")
            for i in range(12):
                img_id = p_i * 100 + i
                bbox = "2,2,14,14" if i != 5 else "2,2,14"
                f.write(f"{person}\t{img_id}\t{i}\thttp://h/{img_id}.jpg\t{bbox}\tff\n")
                if i != 11:  # one manifest row has no picture yet
                    cls = i % 4
                    pic = rng.integers(0, 60, (16, 16, 3)) + cls * 60
                    write_png(os.path.join(images, folder, f"{img_id}.png"), pic)
                    labels.append({"image_path": f"data/raw/images/{folder}/{img_id}.jpg", "emotion": EMOTIONS[cls]})
        f.write("Dee\t900\t1\thttp://h/900.jpg\t1,1,5,5\tff\n")  # person without a folder
    labels.append({"image_path": "data/raw/images/Cy/299.jpg", "error": "cannot read"})
    labels.append({"image_path": "data/raw/images/Cy/298.jpg", "emotion": "bored"})
    labels_path = os.path.join(tmp, "labels.json")
    with open(labels_path, "w") as f:
        json.dump(labels, f)
    return dict(images=images, manifest=manifest, labels=labels_path, tmp=tmp)


def test_pending_preprocess_features_train(spark, layout):
    pend = workflows.pending_images(spark, layout["manifest"], layout["images"], ext=".png")
    got = sorted(r.image_id for r in pend.collect())
    assert got == [11, 111, 211, 900]

    summary = {r.status: r.n for r in workflows.preprocess(
        spark, layout["manifest"], layout["images"], os.path.join(layout["tmp"], "crops"), size=8).collect()}
    assert summary == {"ok": 30, "bad_bbox": 3, "missing_image": 4}
    crops = spark.read.parquet(os.path.join(layout["tmp"], "crops")).filter("status = 'ok'")
    assert crops.select(F.min("image.height"), F.max("image.width")).first() == (8, 8)

    feats_path = os.path.join(layout["tmp"], "features")
    fs = {r.status: r.n for r in workflows.features(
        spark, layout["manifest"], layout["images"], feats_path, size=8, method="nearest").collect()}
    assert fs["ok"] == 30

    hist = workflows.train(spark, layout["labels"], feats_path, os.path.join(layout["tmp"], "run"),
                           model="centroid", run_id="r1")
    rows = {(r.split, r.metric): r.value for r in hist.collect()}
    assert rows[("train", "accuracy")] > 0.9  # classes differ strongly in brightness
    samples = spark.read.parquet(os.path.join(layout["tmp"], "run", "samples"))
    assert samples.count() == 30  # unknown class, error record and missing features are dropped


def test_manifest_pictures_broadcast_and_shuffle_paths_agree(spark, layout):
    def rows(df):
        return sorted((r.person, r.image_id, r.status, r.bbox_coords and tuple(r.bbox_coords),
                       r.image and (r.image.height, r.image.width, bytes(r.image.data))) for r in df.collect())

    todo = workflows._rows(spark, layout["manifest"], "/nowhere/yet")
    small = workflows._manifest_pictures(spark, todo, layout["images"])
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "image#" in x]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = rows(workflows._manifest_pictures(spark, todo, layout["images"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(small) == big
    assert len(big) == 37


def test_train_on_empty_raises(spark, layout):
    feats_path = os.path.join(layout["tmp"], "nofeatures")
    spark.createDataFrame([], "person string, image_id bigint, features array<float>, status string") \
        .write.parquet(feats_path)
    with pytest.raises(ValueError):
        workflows.train(spark, layout["labels"], feats_path, os.path.join(layout["tmp"], "run2"))


def test_streaming_ingest_resumes(spark, tmp):
    from featureflow.streaming.ingest import stream_samples

    feats = spark.createDataFrame([("Ann", i, [float(i)]) for i in range(10)],
                                  "person string, image_id bigint, features array<float>")
    inbox = os.path.join(tmp, "inbox")
    os.makedirs(inbox)
    out, ckpt = os.path.join(tmp, "samples"), os.path.join(tmp, "ckpt")

    def drop(name, ids):
        with open(os.path.join(inbox, name), "w") as f:
            json.dump([{"image_path": f"x/Ann/{i}.jpg", "emotion": "happy"} for i in ids]
                      + [{"image_path": "x/Ann/3.jpg", "error": "bad"}], f)

    drop("a.json", [0, 1, 2])
    q = stream_samples(spark, inbox, feats, out, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 3
    drop("b.json", [4, 5, 42])
    q = stream_samples(spark, inbox, feats, out, ckpt)
    q.awaitTermination(120)
    assert sorted(r.image_id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 4, 5]


def test_cluster_and_project_vector_files(spark, tmp):
    rng = np.random.default_rng(3)
    root = os.path.join(tmp, "features")
    for person, centre in [("Ann", 0.0), ("Bob", 5.0), ("Cy", 10.0)]:
        os.makedirs(os.path.join(root, person))
        for i in range(8):
            np.save(os.path.join(root, person, f"{i}.npy"), (centre + rng.normal(0, 0.1, 16)).astype(np.float32))
    np.save(os.path.join(root, "Cy", "bad.npy"), np.array(["x"]))
    summary = {r.status: r.n for r in workflows.cluster_vectors(
        spark, root, os.path.join(tmp, "clusters"), k=3).collect()}
    assert summary == {"ok": 24, "not_numeric": 1}
    cl = spark.read.option("header", True).csv(os.path.join(tmp, "clusters"))
    assert cl.columns == ["person", "filename", "cluster"]
    # each person's vectors form one cluster
    assert cl.groupBy("person").agg(F.countDistinct("cluster").alias("c")).filter("c > 1").count() == 0
    pts = workflows.project_vectors(spark, root, os.path.join(tmp, "points"))
    assert pts.count() == 24 and set(pts.columns) == {"person", "filename", "x", "y"}


def test_train_from_vector_files(spark, tmp):
    rng = np.random.default_rng(5)
    root = os.path.join(tmp, "vectors")
    labels = []
    for person in ["Ann", "Bob"]:
        os.makedirs(os.path.join(root, person))
        for i in range(20):
            cls = i % 2
            np.save(os.path.join(root, person, f"{i}.npy"), (cls * 4.0 + rng.normal(0, 0.1, 8)).astype(np.float32))
            labels.append({"image_path": f"data/raw/images/{person}/{i}.jpg", "emotion": ["happy", "sad"][cls]})
    labels.append({"image_path": "data/raw/images/Ann/99.jpg", "emotion": "happy"})  # no vector file
    labels_path = os.path.join(tmp, "labels.json")
    with open(labels_path, "w") as f:
        json.dump(labels, f)
    hist = workflows.train(spark, labels_path, root, os.path.join(tmp, "run"), model="centroid",
                           features_format="npy")
    rows = {(r.split, r.metric): r.value for r in hist.collect()}
    assert rows[("train", "accuracy")] == 1.0
    assert spark.read.parquet(os.path.join(tmp, "run", "samples")).count() == 40


def test_stages_resume(spark, layout):
    out = os.path.join(layout["tmp"], "resumable")
    calls = os.path.join(layout["tmp"], "calls")
    os.makedirs(calls)

    def make():
        def model(batch):
            open(os.path.join(calls, os.urandom(8).hex()), "w").close()
            return batch.reshape(len(batch), -1)[:, :4]
        return model

    first = {r.status: r.n for r in workflows.features(spark, layout["manifest"], layout["images"], out, size=4,
                                                       make_predict_fn=make).collect()}
    rows, n_calls = spark.read.parquet(out).count(), len(os.listdir(calls))
    assert first["ok"] and n_calls
    again = {r.status: r.n for r in workflows.features(spark, layout["manifest"], layout["images"], out, size=4,
                                                       make_predict_fn=make).collect()}
    assert again == first and spark.read.parquet(out).count() == rows and len(os.listdir(calls)) == n_calls


def test_preprocess_writes_a_folder_per_person(spark, layout):
    out = os.path.join(layout["tmp"], "crops")
    before = workflows.preprocess(spark, layout["manifest"], layout["images"], out, size=8).collect()
    assert any(d.startswith("person=") for d in os.listdir(out))
    assert sorted(workflows.preprocess(spark, layout["manifest"], layout["images"], out, size=8).collect()) == sorted(before)


def test_label_stage_and_pixel_pipeline(spark, layout):
    records = os.path.join(layout["tmp"], "records")

    def make():
        return lambda arrays: ["happy" if a.mean() > 100 else "sad" for a in arrays]

    summary = {r.status: r.n for r in workflows.label(spark, layout["images"], records, make).collect()}
    assert summary["ok"] > 0
    lines = spark.read.schema("image_path string, emotion string, error string").json(records).collect()
    assert all((r.emotion is None) != (r.error is None) for r in lines)
    px = os.path.join(layout["tmp"], "pixels")
    workflows.pixels(spark, layout["manifest"], layout["images"], px, size=6, box="xyxy", channels=3)
    good = spark.read.parquet(px).filter("status = 'ok'").first()
    assert len(good.features) == 6 * 6 * 3 and good.features[0] == good.features[1] == good.features[2]
    hist = workflows.train(spark, records, px, os.path.join(layout["tmp"], "pixelrun"), model="centroid",
                           labels_multiline=False, run_id="px")
    n = hist.count()
    assert {r.metric for r in hist.collect()} == {"accuracy", "f1", "loss"}
    again = workflows.train(spark, records, px, os.path.join(layout["tmp"], "pixelrun"), model="centroid",
                            labels_multiline=False, run_id="px")
    assert again.count() == n  # replaced, not added


@pytest.mark.parametrize("model,params,steps", [
    ("forest", {"num_trees": 3}, {1, 2, 3}), ("network", {"hidden": (8,), "epochs": 2, "shards": 2}, {1, 2})])
def test_history_of_every_step(spark, layout, model, params, steps):
    feats_path = os.path.join(layout["tmp"], "features")
    workflows.features(spark, layout["manifest"], layout["images"], feats_path, size=8, method="nearest")
    hist = workflows.train(spark, layout["labels"], feats_path, os.path.join(layout["tmp"], "steps"), model=model, run_id=model, **params)
    rows = hist.collect()
    assert {r.step for r in rows} == steps and {r.metric for r in rows} == {"accuracy", "f1", "loss"}
    assert len(rows) == len({(r.step, r.split, r.metric) for r in rows})
