import pytest

from featureflow.operators import joins


@pytest.fixture()
def lm(spark):
    labels = spark.createDataFrame([(1, "happy"), (2, "sad"), (2, "fear"), (None, "angry")],
                                   "image_id bigint, emotion string")
    manifest = spark.createDataFrame([(1, "A"), (2, "B"), (2, "B2"), (3, "C"), (None, "N")],
                                     "image_id bigint, name string")
    return labels, manifest


def test_join_labels_fanout_and_nulls(spark, lm):
    labels, manifest = lm
    out = joins.join_labels(labels, manifest, "image_id")
    assert out.count() == 1 + 2 * 2  # id 1 once; id 2: 2 labels x 2 rows; NULL keys never match
    with pytest.raises(ValueError):
        joins.join_labels(labels, manifest, "image_id", unique=True)


def test_presence_semi_anti(spark, lm):
    labels, manifest = lm
    pres = {r.image_id: r.present for r in joins.with_presence(manifest, labels, "image_id").collect()
            if r.image_id is not None}
    assert pres == {1: True, 2: True, 3: False}
    assert joins.with_presence(manifest, labels, "image_id").count() == manifest.count()
    assert joins.present_only(manifest, labels, "image_id").count() == 3
    assert sorted(r.name for r in joins.pending(manifest, labels, "image_id").collect()) == ["C", "N"]


def test_join_features_two_keys(spark):
    labs = spark.createDataFrame([("A", 1, 5), ("A", 2, 3), ("B", 1, 0)], "person string, image_id bigint, label int")
    feats = spark.createDataFrame([("A", 1, [0.1]), ("B", 2, [0.2])], "person string, image_id bigint, features array<float>")
    out = joins.join_features(labs, feats).collect()
    assert [(r.person, r.image_id, r.label) for r in out] == [("A", 1, 5)]


def test_attach_names_guard(spark):
    pts = spark.createDataFrame([(1, 0.5, 1.0), (2, 0.1, 0.2)], "sample_id bigint, x double, y double")
    names = spark.createDataFrame([(1, "a"), (2, "b")], "sample_id bigint, name string")
    assert sorted(r.name for r in joins.attach_names(pts, names).collect()) == ["a", "b"]
    with pytest.raises(Exception):
        joins.attach_names(pts, names.filter("sample_id = 1")).collect()
    with pytest.raises(Exception):
        joins.attach_names(pts, names.union(names)).collect()


def test_union_manifests(spark):
    a = spark.createDataFrame([("x", 1)], "name string, image_id bigint")
    b = spark.createDataFrame([(2, "y", "extra")], "image_id bigint, name string, note string")
    u = joins.union_manifests(a, b, sources=["a", "b"]).orderBy("image_id").collect()
    assert [(r.name, r.image_id, r.note, r.source) for r in u] == [("x", 1, None, "a"), ("y", 2, "extra", "b")]


def test_join_labels_default_key_names_the_person(spark):
    labels = spark.createDataFrame([("A", 1, "happy"), ("B", 1, "sad")], "person string, image_id bigint, emotion string")
    manifest = spark.createDataFrame([("A", 1, "u1"), ("B", 1, "u2")], "person string, image_id bigint, url string")
    assert sorted((r.emotion, r.url) for r in joins.join_labels(labels, manifest).collect()) == [("happy", "u1"), ("sad", "u2")]
