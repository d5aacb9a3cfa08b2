import pytest
from pyspark.sql import functions as F

from featureflow.operators import aggregates, splits


def test_hash_split_same_under_repartition(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    a = {r.k: r.split for r in splits.hash_split(df, "k").collect()}
    b = {r.k: r.split for r in splits.hash_split(df.repartition(7), "k").collect()}
    c = {r.k: r.split for r in splits.hash_split(df.coalesce(1), "k").collect()}
    assert a == b == c
    counts = {r.split: r.n for r in aggregates.split_counts(splits.hash_split(df, "k")).collect()}
    assert sum(counts.values()) == 3000
    assert set(counts) == {"train", "val", "test"}
    assert 0.70 < counts["train"] / 3000 < 0.80


def test_hash_split_weights_and_seed(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    s = splits.hash_split(df, "k", splits.SPLIT_70_15_15, seed=3)
    assert {r.split for r in s.select("split").distinct().collect()} == {"train", "val", "test"}
    s0 = {r.k: r.split for r in splits.hash_split(df, "k", seed=0).collect()}
    s3 = {r.k: r.split for r in splits.hash_split(df, "k", seed=3).collect()}
    assert s0 != s3


def test_hash_split_composite_and_null_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "person string, image_id bigint")
    assert splits.hash_split(df, ["person", "image_id"]).count() == 3
    bad = spark.createDataFrame([(None,)], "k bigint")
    with pytest.raises(Exception):
        splits.hash_split(bad, "k").collect()


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_batch_id_exact(spark, parts):
    df = spark.range(0, 2003).withColumnRenamed("id", "k").repartition(5)
    out = splits.with_batch_id(df, "k", 500, index_col="pos", num_partitions=parts)
    rows = out.collect()
    assert len(rows) == 2003
    assert all(r.pos == r.k and r.batch_id == r.k // 500 for r in rows)


def test_batch_id_plan_has_no_single_partition_window_on_rows(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    plan = splits.with_batch_id(df, "k", 10)._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("__pid" in x and "k#" not in x for x in windows)  # numbers ranges, not rows


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_batch_id_exact_with_other_columns(spark, reuse, tmp):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(0, 200_000, numPartitions=6).select(
            F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        df.write.parquet(f"{tmp}/t")
        for rows in (df, spark.read.parquet(f"{tmp}/t")):
            out = splits.with_batch_id(rows, "k", 1000, index_col="pos", num_partitions=8)
            bad = out.filter((F.col("pos") != F.col("k")) | (F.col("batch_id") != F.expr("k div 1000"))
                             | (F.col("payload") != F.sha2(F.col("k").cast("string"), 256)))
            assert out.count() == 200_000 and bad.count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_batch_id_null_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 1)], "a string, b int")
    out = splits.with_batch_id(df, ["a", "b"], 2, index_col="pos").collect()
    assert sorted((r.pos, r.a, r.b) for r in out) == [(0, None, 1), (1, None, 2), (2, "a", 1)]


def test_batch_id_exact_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(0, 200_000, numPartitions=6).withColumnRenamed("id", "k")
        out = splits.with_batch_id(df, "k", 1000, index_col="pos", num_partitions=8)
        assert out.filter((F.col("pos") != F.col("k")) | (F.col("batch_id") != F.expr("k div 1000"))).count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
