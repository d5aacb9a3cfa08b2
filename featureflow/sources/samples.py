"""Sample tables (label + feature vector), stored as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLES_SCHEMA = "sample_id bigint, label int, features array<float>"


def read_samples(
    spark: SparkSession, path: str | list[str], schema: str = SAMPLES_SCHEMA,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Parquet scan with an imposed schema (no inference job, the same types
    whatever wrote the files). Split folders written by ``write_samples``
    (``split=train/...``) come back as a ``split`` column, and a filter on it
    prunes folders."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.schema(schema).parquet(*paths)
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    return df


def require_dim(df: DataFrame, dim: int, features_col: str = "features", status_col: str = "status") -> DataFrame:
    """Mark vectors that are NULL or not ``dim`` long (status ``bad_dim``)."""
    from featureflow.operators.columns import with_status

    bad = F.col(features_col).isNull() | (F.size(features_col) != dim)
    return with_status(df, bad, "bad_dim", status_col)
