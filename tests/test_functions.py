from pyspark.sql import functions as F

from featureflow.functions import (
    EMOTION_CODES, base_name, bbox_ok, bbox_parts, cut_points, extension, image_id, label_code,
    normalized_name, parent_folder, split_bucket, stem, strip_scheme,
)


def test_image_id_pattern(spark):
    df = spark.createDataFrame(
        [("data/raw/Ann_Example/12.jpg",), ("x/13.png",), ("x/abc.jpg",), ("",), (None,), ("a/99999999999999999999.jpg",)],
        "p string")
    got = [r[0] for r in df.select(image_id(F.col("p"), to="int")).collect()]
    assert got == [12, None, None, None, None, None]


def test_path_parts_follow_splitext(spark):
    import os

    paths = ["a/b/c.jpg", "c.jpg", "a/b/", "a/.hidden", "a/b.c.d", "a/..x", "a/x.", "/r/Ann_Ex/12.npy"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select(parent_folder(F.col("p")), base_name(F.col("p")),
                     stem(base_name(F.col("p"))), extension(base_name(F.col("p")))).collect()
    for p, (par, base, st, ext) in zip(paths, rows):
        parts = p.split("/")
        assert par == (parts[-2] if len(parts) >= 2 else None)
        assert base == os.path.basename(p)
        assert (st, ext) == os.path.splitext(os.path.basename(p))


def test_normalized_name_and_scheme(spark):
    df = spark.createDataFrame([("Ann Mary Example", "file:/tmp/a.jpg"), ("B", "file:///tmp/b"), (None, "hdfs://n/x")],
                               "n string, p string")
    rows = df.select(normalized_name(F.col("n")), strip_scheme(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [("Ann_Mary_Example", "/tmp/a.jpg"), ("B", "/tmp/b"), (None, "hdfs://n/x")]


def test_bbox_parse_rules(spark):
    texts = ["10,20,110,140", " 1, 2,3,4", "1,2,3", "a,b,c,d", None, "", "1,2,3,4,5", "-1,+2,3,4",
             "1.0,2,3,4", "1,2,3,99999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(bbox_parts(F.col("t")).alias("p")).select("p", bbox_ok(F.col("p")).alias("ok")).collect()
    oks = [r.ok for r in rows]
    assert oks == [True, True, False, False, False, False, False, True, False, False]
    assert rows[1].p == [1, 2, 3, 4] and rows[7].p == [-1, 2, 3, 4]


def test_label_code(spark):
    df = spark.createDataFrame([("happy",), ("surprise",), ("bored",), (None,)], "e string")
    got = [r[0] for r in df.select(label_code(F.col("e"), EMOTION_CODES)).collect()]
    assert got == [5, 6, -1, -1]


def test_split_bucket_matches_md5_rule(spark):
    import hashlib

    df = spark.range(0, 200).withColumnRenamed("id", "k")
    got = {r.k: r.b for r in df.select("k", split_bucket(F.col("k")).alias("b")).collect()}
    for k, b in got.items():
        assert b == int(hashlib.md5(str(k).encode()).hexdigest()[:7], 16) % 1000
    seeded = df.select("k", split_bucket(F.col("k"), seed=7).alias("b")).collect()
    assert seeded[3].b == int(hashlib.md5(b"7:3").hexdigest()[:7], 16) % 1000


def test_cut_points_normalise():
    assert cut_points({"a": 0.75, "b": 0.15, "c": 0.10}) == [("a", 750), ("b", 900), ("c", 1000)]
    assert cut_points({"a": 3, "b": 1}) == [("a", 750), ("b", 1000)]
