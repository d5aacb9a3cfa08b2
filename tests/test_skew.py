"""A key holding a third of the rows: results stay exact on the skew paths
(AQE skew-join splitting forced by tiny thresholds, partial aggregation)."""

import pytest
from pyspark.sql import functions as F

from featureflow.operators import aggregates, evaluate, joins, splits


@pytest.fixture()
def skewed(spark):
    n = 30000
    # key 0 holds a third of the rows
    left = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                    F.col("id").alias("row"))
    right = spark.range(0, n, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return left, right


@pytest.fixture()
def force_skew(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_joins_exact_under_skew(spark, skewed, force_skew):
    left, right = skewed
    inner = joins.join_labels(left, right, "k")
    # key 0 (10000 rows) matches once; other even keys match once
    want = left.filter(F.col("k") % 2 == 0).count()
    assert inner.count() == want
    pres = joins.with_presence(left, right.union(right), "k")
    assert pres.count() == left.count()
    assert pres.filter("present").count() == want
    assert joins.pending(left, right.union(right), "k").count() == left.count() - want
    assert joins.present_only(left, right.union(right), "k").count() == want


def test_grouped_counts_under_skew(spark, skewed):
    left, _ = skewed
    tagged = left.withColumn("split", F.when(F.col("k") == 0, F.lit("train")).otherwise(F.lit("test")))
    counts = {r.split: r.n for r in aggregates.split_counts(tagged).collect()}
    assert counts == {"train": 10000, "test": 20000}
    pred = left.select((F.col("k") % 3).cast("int").alias("label"), (F.col("row") % 3).cast("int").alias("prediction"))
    conf = evaluate.confusion(pred)
    assert conf.agg(F.sum("n")).first()[0] == 30000


def test_split_and_batches_under_skew(spark, skewed):
    left, _ = skewed
    s = splits.hash_split(left, "row")
    assert s.count() == 30000
    b = splits.with_batch_id(left, ["k", "row"], 1000, index_col="pos")
    rows = b.select("k", "row", "pos", "batch_id").collect()
    order = sorted(rows, key=lambda r: (r.k, r.row))
    assert [r.pos for r in order] == list(range(30000))
    assert all(r.batch_id == r.pos // 1000 for r in rows)


def test_attach_names_hot_repeated_key_raises(spark):
    n = 30_000
    pts = spark.range(0, n).select(F.col("id").alias("sample_id"), F.rand(1).alias("x"))
    # every point has a name, and key 0 also holds n // 2 more rows (a third of all name rows)
    names = spark.range(0, n + n // 2).select(
        F.when(F.col("id") >= n, F.lit(0)).otherwise(F.col("id")).alias("sample_id"),
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    with pytest.raises(Exception, match="name key repeated"):
        joins.attach_names(pts, names).collect()
    ok = spark.range(0, n).select(F.col("id").alias("sample_id"), F.col("id").cast("string").alias("name"))
    assert joins.attach_names(pts, ok).filter(F.col("name") != F.col("sample_id").cast("string")).count() == 0


@pytest.fixture()
def skewed_files(spark, tmp, skewed):
    left, right = skewed
    hot = right.unionByName(left.filter("k = 0").select("k", F.col("row").alias("v")))
    for name, df in (("left", left.repartition(4)), ("right", right.repartition(4)), ("hot", hot.repartition(4))):
        df.write.parquet(f"{tmp}/{name}")
    return {n: spark.read.parquet(f"{tmp}/{n}") for n in ("left", "right", "hot")}


@pytest.mark.parametrize("right", ["right", "hot"])
def test_hot_keys_are_split(spark, skewed_files, force_skew, right):
    left, right = skewed_files["left"], skewed_files[right]

    def final_plan(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    assert "skew=true" in final_plan(joins.present_only(left, right, "k"))
    assert "skew=true" in final_plan(joins.pending(left, right, "k"))
    assert final_plan(joins.with_presence(left, right, "k")).count("skew=true") == 2


def test_hot_points_are_split(spark, tmp, skewed_files, force_skew):
    spark.range(0, 30000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name")).write.parquet(f"{tmp}/names")
    out = joins.attach_names(skewed_files["left"], spark.read.parquet(f"{tmp}/names"), "k")
    assert len(out.collect()) == 30000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
