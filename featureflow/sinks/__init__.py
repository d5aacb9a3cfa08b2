"""Writers: tables, sample folders, models, metric history.

Every writer is one Spark job with Spark's commit protocol: output appears
only when the job succeeded, so an interrupted run never leaves a folder that
looks finished (the weakness of a "folder exists" resume test).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None,
    mode: str = "overwrite", header: bool = True, partition_by: Sequence[str] | None = None,
) -> None:
    """Parquet (default), CSV with header, or JSON lines; optional projection."""
    if columns:
        df = df.select(*columns)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", header).csv(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_samples(
    df: DataFrame, path: str, partition_by: Sequence[str] | None = ("split",),
    max_records: int | None = None, mode: str = "overwrite",
) -> None:
    """Sample table as Parquet in one job, one folder per split value
    (``split=train/``...), at most ``max_records`` rows per file.

    No shuffle by the split column first: that would send a whole split (the
    train split is most of the data) through one task. Each task writes at
    most one file per split value it holds (more when ``max_records`` cuts)."""
    parts = [c for c in (partition_by or []) if c in df.columns]
    w = df.write.mode(mode)
    if max_records:
        w = w.option("maxRecordsPerFile", int(max_records))
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Add metric history rows (``run_id, step, split, metric, value``). Rows of
    the same runs and steps are replaced, so a retry leaves no second copy: each
    (run_id, step) is a folder of its own."""
    (metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "step").parquet(path))


METRICS_SCHEMA = "split string, metric string, value double, run_id string, step int"


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metric history: ``run_id, step, split, metric, value``."""
    return spark.read.schema(METRICS_SCHEMA).parquet(path).select("run_id", "step", "split", "metric", "value")


def save_model(model, path: str, overwrite: bool = True) -> None:
    """Spark ML model, or a centroid model (stored as a small Parquet table)."""
    from featureflow.operators.classify import CentroidModel

    if isinstance(model, CentroidModel):
        spark = SparkSession.getActiveSession()
        rows = [(lab, [float(x) for x in c], n) for lab, c, n in
                zip(model.labels, model.centers, model.counts or [0] * len(model.labels))]
        df = spark.createDataFrame(rows, f"label {model.label_type}, center array<double>, n bigint")
        df.coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
        return
    w = model.write()
    if overwrite:
        w = w.overwrite()
    w.save(path)


def load_model(kind, path: str, spark: SparkSession | None = None):
    """``kind`` is a Spark ML model class (e.g. ``RandomForestClassificationModel``)
    or ``"centroids"``."""
    if kind == "centroids":
        from featureflow.operators.classify import CentroidModel

        spark = spark or SparkSession.getActiveSession()
        df = spark.read.parquet(path)
        rows = sorted(df.collect(), key=lambda r: r["label"])  # the model itself: it is held by the driver
        return CentroidModel(labels=[r["label"] for r in rows],
                             centers=np.array([r["center"] for r in rows], dtype=np.float64),
                             label_type=dict(df.dtypes)["label"], counts=[r["n"] for r in rows])
    return kind.load(path)


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Preview: the first ``n`` rows (a limit, no full scan)."""
    return df.limit(n)


__all__ = ["append_metrics", "first_rows", "load_model", "read_metrics", "save_model", "write_samples", "write_table"]
