"""Plan checks: no pair-producing joins anywhere, no Python in the row-level
operators, pushed filters and pruned columns at the scan, no shuffle where none
is needed."""

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from featureflow.operators import columns, joins, splits
from featureflow.plans import queries as Q


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_no_cross_products(spark, name):
    p = plan(Q.queries()[name](spark, SF01))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["valid_labels", "path_ids", "normalize_names", "path_parts", "filter_files",
                                  "parse_bbox", "status_summary", "encode_label", "encode_label_table",
                                  "join_labels", "join_features", "presence", "present_only", "pending",
                                  "attach_names", "union_manifests", "read_samples", "num_classes", "batch_id",
                                  "hash_split", "split_counts"])
def test_relational_queries_stay_in_the_jvm(spark, name):
    p = plan(Q.queries()[name](spark, SF01))
    assert "Python" not in p and "ArrowEval" not in p and "MapInPandas" not in p


def test_label_filter_below_join(spark):
    labels = spark.read.parquet(f"{SF01}/events.parquet").select(
        F.col("event_id").alias("image_id"), F.col("event_type").alias("emotion"))
    manifest = spark.read.parquet(f"{SF01}/orders.parquet").select(F.col("o_orderkey").alias("image_id"))
    coded = columns.encode_label(labels, "emotion", Q.EVENT_CODES)
    joined = joins.join_labels(coded, manifest, "image_id")
    text = optimized(joined)
    join_at = text.index("Join Inner")
    filter_at = text.index("Filter", join_at)  # the label filter sits under the join
    assert "element_at" in text[filter_at:filter_at + 400]


def test_scan_prunes_and_pushes(spark):
    p = plan(Q.q_valid_labels(spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint,quality:int,toxic:int>" in p
    assert "IsNotNull(quality)" in p
    p2 = plan(Q.q_path_ids(spark, SF01))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p2


def test_row_operators_do_not_shuffle(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    assert "Exchange" not in plan(splits.hash_split(emb, "vec_id"))
    assert "Exchange" not in plan(Q.nc_predictions(spark, SF01))
    assert "Exchange" not in plan(Q.q_parse_bbox(spark, SF01))


def test_split_filter_prunes_sample_folders(spark, tmp):
    from featureflow import sinks
    from featureflow.sources.samples import read_samples

    emb = splits.hash_split(spark.read.parquet(f"{SF01}/embeddings.parquet"), "vec_id").select(
        F.col("vec_id").alias("sample_id"), "label", F.col("embedding").alias("features"), "split")
    sinks.write_samples(emb, f"{tmp}/s")
    p = plan(read_samples(spark, f"{tmp}/s").filter("split = 'test'"))
    assert "PartitionFilters: [isnotnull(split" in p
