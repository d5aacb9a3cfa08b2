import pytest
from pyspark.sql import functions as F

from featureflow.operators import columns


def test_valid_labels_and_encode(spark):
    df = spark.createDataFrame(
        [("p/A/1.jpg", "happy", None), ("p/A/2.jpg", None, "cannot read"), ("p/B/3.jpg", "bored", None),
         ("p/B/4.png", "sad", None), ("5.jpg", "fear", None)],
        "image_path string, emotion string, error string")
    v = columns.valid_labels(df)
    assert v.count() == 4
    enc = columns.encode_label(columns.with_image_id(v), "emotion")
    rows = sorted((r.image_path, r.label, r.image_id) for r in enc.collect())
    # unknown class dropped; .png path has no id; a path without folder still matches the id rule? no slash -> NULL
    assert rows == [("5.jpg", 1, None), ("p/A/1.jpg", 5, 1), ("p/B/4.png", 3, None)]
    keep = columns.encode_label(v, "emotion", keep_unknown=True)
    assert sorted(r.label for r in keep.collect()) == [-1, 1, 3, 5]


def test_class_codes_in_name_order(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "c string")
    assert {r.name: r.code for r in columns.class_codes(df, "c").collect()} == {"a": 0, "b": 1, "c": 2}


def test_encode_label_from_table(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "c string")
    mapping = spark.createDataFrame([("x", 0), ("y", 1)], "name string, code int")
    assert sorted(r.label for r in columns.encode_label(df, "c", mapping).collect()) == [0, 1]
    bad = spark.createDataFrame([("x", 0), ("x", 1)], "name string, code int")
    with pytest.raises(ValueError):
        columns.encode_label(df, "c", bad)
    twice = columns.encode_label(df, "c", mapping.union(mapping), keep_unknown=True)
    assert sorted((r.c, r.label) for r in twice.collect()) == [("x", 0), ("y", 1), ("z", -1)]


def test_parse_bbox_status(spark):
    df = spark.createDataFrame([("1,2,3,4",), ("1,2,3",), (None,), ("a,b,c,d",)], "bbox string")
    rows = columns.parse_bbox(df).collect()
    assert [(r.bbox_coords, r.status) for r in rows] == [
        ([1, 2, 3, 4], "ok"), (None, "bad_bbox"), (None, "bad_bbox"), (None, "bad_bbox")]


def test_status_first_failure_wins(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    s = columns.with_status(df, F.col("x") == 1, "first")
    s = columns.with_status(s, F.col("x") <= 2, "second")
    assert [r.status for r in s.orderBy("x").collect()] == ["first", "second", "ok"]
    assert columns.drop_failed(s).count() == 1


def test_paths_and_names(spark):
    df = spark.createDataFrame([("Ann Example", 12)], "name string, image_id bigint")
    df = columns.normalize_name(df, "name", "person")
    out = columns.with_image_path(df, "/data/raw/", "person", "image_id").first()
    assert out.image_path == "/data/raw/Ann_Example/12.jpg"
    parts = columns.with_path_parts(spark.createDataFrame([("/r/Ann/12.npy",)], "path string")).first()
    assert (parts.parent, parts.base_name, parts.stem, parts.ext) == ("Ann", "12.npy", "12", ".npy")


def test_filter_files(spark):
    df = spark.createDataFrame([(".a.npy",), ("b.npy",), ("c.txt",), ("d.NPY",)], "base_name string")
    assert [r.base_name for r in columns.filter_files(df).collect()] == ["b.npy"]


def test_with_vector_idempotent(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "features array<double>")
    v = columns.with_vector(df)
    assert columns.with_vector(v) is v
    assert v.first().features_vector.toArray().tolist() == [1.0, 2.0]


def test_no_python_in_row_plans(spark):
    df = spark.createDataFrame([("p/A/1.jpg", "happy", None, "1,2,3,4")],
                               "image_path string, emotion string, error string, bbox string")
    out = columns.parse_bbox(columns.encode_label(columns.with_image_id(columns.valid_labels(df)), "emotion"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
