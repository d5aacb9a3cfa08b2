"""Stages that go on: late pictures, null ids, repeated runs, failed first runs."""

import os
import time

import numpy as np
import pytest
from conftest import write_png
from pyspark.sql import functions as F

from featureflow.operators import splits
from featureflow.plans import ledger, workflows


def manifest(tmp, rows):
    path = os.path.join(tmp, "m.txt")
    with open(path, "w") as f:
        f.write("name\timage_id\tface_id\turl\tbbox\tsha256\n")
        for name, i, box in rows:
            f.write(f"{name}\t{i}\t1\thttp://h/x.jpg\t{box}\tff\n")
    return path


def picture(tmp, person, i):
    write_png(os.path.join(tmp, "raw", person, f"{i}.png"), np.full((16, 16, 3), 90))


@pytest.mark.parametrize("stage", ["preprocess", "features", "pixels"])
def test_late_pictures_and_null_ids(spark, tmp, stage):
    m = manifest(tmp, [("Ann A", 1, "1,1,9,9"), ("Ann A", 2, "1,1,9,9"), ("Ann A", "n/a", "1,1,9,9"), ("Bob", 3, "1,1"), ("Bob", 4, "1,1,9,9")])
    picture(tmp, "Ann_A", 1)
    broken = os.path.join(tmp, "raw", "Bob", "4.png")
    os.makedirs(os.path.dirname(broken))
    with open(broken, "wb") as f:
        f.write(b"no picture")
    out = os.path.join(tmp, "out")

    def run():
        return {r.status: r.n for r in getattr(workflows, stage)(spark, m, os.path.join(tmp, "raw"), out, size=4).collect()}

    first = {"ok": 1, "missing_image": 2, "bad_bbox": 1, "undecodable": 1}
    assert run() == first and run() == first
    assert spark.read.parquet(out).count() == 5  # nothing new: nothing added
    picture(tmp, "Ann_A", 2)
    os.remove(broken)
    picture(tmp, "Bob", 4)
    late = {"ok": 3, "missing_image": 1, "bad_bbox": 1}
    assert run() == late and run() == late
    got = spark.read.parquet(out)
    assert got.filter("status = 'ok'").count() == 3 and got.filter("image_id IS NULL").count() == 1
    assert sorted(r.attempt for r in got.select("attempt").collect()) == [1] * 5 + [2] * 2


def test_a_failed_first_run_can_start_again(spark, tmp):
    m = manifest(tmp, [("Ann", 1, "1,1,9,9")])
    picture(tmp, "Ann", 1)
    out = os.path.join(tmp, "out")
    os.makedirs(out)  # what a failed run leaves

    def fails():
        def model(batch):
            raise RuntimeError("out of luck")
        return model

    def summary(**kw):
        return {r.status: r.n for r in workflows.features(spark, m, os.path.join(tmp, "raw"), out, size=4, **kw).collect()}

    try:
        assert "ok" not in summary(make_predict_fn=fails)  # a stage may fail or mark its rows
    except Exception as e:  # noqa: BLE001
        assert "out of luck" in str(e)
    assert summary() == {"ok": 1} and summary() == {"ok": 1}


def test_latest_and_compaction(spark, tmp):
    schema = "k string, status string"
    rows = [("a", "missing_image", 1), ("a", "ok", 2), (None, "missing_image", 1), (None, "missing_image", 1), ("b", "ok", 1)]
    spark.createDataFrame(rows, "k string, status string, attempt int").write.partitionBy("attempt").parquet(f"{tmp}/t")
    want = [("a", "ok", 2), ("b", "ok", 1), (None, "missing_image", 1), (None, "missing_image", 1)]
    got = ledger.latest(ledger.read_attempts(spark, f"{tmp}/t", schema), ["k"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    ledger.compact(spark, f"{tmp}/t", f"{tmp}/c", ["k"], schema)
    again = ledger.read_attempts(spark, f"{tmp}/c", schema).collect()
    assert sorted((tuple(r) for r in again), key=str) == sorted(want, key=str)
    assert ledger.read_attempts(spark, f"{tmp}/none", schema).count() == 0


def test_open_rows_of_keys_with_several_outcomes(spark):
    past = [("a", 1, "ok"), ("a", 2, "bad"), ("a", 2, "missing_image"), ("a", None, "bad"), (None, 3, "ok"), ("b", 4, None)]
    rows = [("a", 1, "ok"), ("a", 1, "bad"), ("a", 2, "ok"), ("a", 2, "bad"), ("a", 2, "worse"), ("a", None, "ok"), ("a", None, "bad"),
            (None, 3, "ok"), (None, 4, "ok"), ("b", 4, "ok"), ("b", 4, None), ("a", 1, None)]
    schema = "person string, image_id bigint, status string"
    got = ledger.todo(spark.createDataFrame(rows, schema), spark.createDataFrame(past, schema), ["person", "image_id"])
    want = [r for r in rows if not any(p[:2] == r[:2] and p[2] and (p[2] == "ok" or p[2] == r[2]) for p in past)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_rows_without_an_id_are_not_compared_pairwise(spark, tmp):
    n = 60_000  # a sort-merge join that compares all pairs took 48 s
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        schema = "person string, image_id bigint, status string"
        for name, status in (("past", "missing_image"), ("rows", "ok")):  # stored, so that no plan knows the values
            spark.range(n).selectExpr("'a' AS person", "CAST(NULL AS BIGINT) AS image_id", f"'{status}' AS status").write.parquet(f"{tmp}/{name}")
        rows, past = (spark.read.schema(schema).parquet(f"{tmp}/{name}") for name in ("rows", "past"))
        begin = time.monotonic()
        assert ledger.todo(rows, past, ["person", "image_id"]).count() == n
        assert time.monotonic() - begin < 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_batches_of_repeated_keys(spark, monkeypatch):
    keys = [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int").repartition(3)
    got = splits.with_batch_id(df, "k", 4, index_col="pos").collect()
    assert sorted(r.pos for r in got) == list(range(10)) and len({r.i for r in got}) == 10
    assert [r.k for r in sorted(got, key=lambda r: r.pos)] == keys
    assert all(r.batch_id == r.pos // 4 for r in got)
    # equal rows, null keys, one key in a third of the rows, over many slices
    monkeypatch.setattr(splits, "SLICE_ROWS", 100)
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 700).alias("k"), F.lit("x").alias("v"))
    got = splits.with_batch_id(df, "k", 500, index_col="pos")
    rows = got.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(9000)) and got.columns == ["k", "v", "batch_id", "pos"] or got.columns == ["k", "v", "pos", "batch_id"]
    assert [r.k is None for r in rows] == [True] * 3000 + [False] * 6000
    assert [r.k for r in rows[3000:]] == sorted(r.k for r in rows[3000:])
