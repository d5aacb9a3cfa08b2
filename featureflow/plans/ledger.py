"""Stages that go on where earlier runs stopped.

A stage's table holds its outcomes: one row per key and attempt, with a status.
Each run writes its rows as a folder of its own (``attempt=N``), so an
interrupted run is repeated under the same number and a finished one is never
touched again. Of a key's rows the latest attempt counts. Keys that are ``ok``
are done; all others are tried again when that can change something. Keys are
compared null-safely, so a row with a null key is there once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.columns import OK
from featureflow.sources.manifest import path_exists

ATTEMPT = "attempt"


def read_attempts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a stage's table, with ``attempt``. The schema is fixed, so a
    table that isn't there, or a folder that a failed run left empty, has no rows."""
    schema = f"{schema}, {ATTEMPT} int"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def same_key(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of each key's last attempt. The last attempts are a grouped
    maximum over keys alone; rows are kept by a semi join with them."""
    last = rows.groupBy(*keys).agg(F.max(ATTEMPT).alias(ATTEMPT))
    return rows.join(last, same_key(rows, last, [*keys, ATTEMPT]), "left_semi")


def todo(rows: DataFrame, past: DataFrame, keys: Sequence[str], available: DataFrame | None = None,
         waiting: str = "missing_image") -> DataFrame:
    """Rows to process, given the latest outcomes ``past(keys, status)``: not
    those that are ok, nor those that failed before they came here (their own
    ``status`` isn't ok) and are known to; nor, if ``available`` names the keys
    that have come, those still ``waiting`` for theirs."""
    # joins on equal columns alone: a condition beside them would compare each row of a
    # repeated key (all those without an id) with every past row of that key
    done, failed = past.filter(F.col("status") == OK), past.filter(F.col("status") != OK)
    open_ = rows.join(done, same_key(rows, done, keys), "left_anti")
    open_ = open_.join(failed, same_key(open_, failed, [*keys, "status"]), "left_anti")
    if available is None:
        return open_
    left = past.filter(F.col("status") == waiting).select(*keys)
    left = left.join(available.select(*keys), list(keys), "left_anti")  # a null key never comes
    return open_.join(left, same_key(open_, left, keys), "left_anti")


def run_stage(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], schema: str,
              work: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = (),
              available: DataFrame | None = None, waiting: str = "missing_image") -> DataFrame:
    """Process what is open of ``rows`` (keys and ``status``) and return the latest
    rows of the table at ``path``. ``work`` gets the open rows and returns the
    columns of ``schema``; a failure that is on record already isn't written
    again, so a run without anything new leaves the table as it is."""
    before = read_attempts(spark, path, schema)
    past = latest(before.select(*keys, "status", ATTEMPT), keys)
    open_ = todo(rows, past, keys, available, waiting)
    if not open_.isEmpty():
        done = work(open_)
        known = past.filter(F.col("status") != OK).select(*keys, "status")
        done = done.join(known, same_key(done, known, [*keys, "status"]), "left_anti")
        number = (before.agg(F.max(ATTEMPT)).first()[0] or 0) + 1
        (done.withColumn(ATTEMPT, F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by, ATTEMPT).parquet(path))
    return latest(read_attempts(spark, path, schema), keys)


def compact(spark: SparkSession, path: str, out_path: str, keys: Sequence[str], schema: str,
            partition_by: Sequence[str] = ()) -> None:
    """Write the latest rows of the table at ``path`` as a table of their own,
    without the failures that later attempts made good. Rows keep their attempt."""
    latest(read_attempts(spark, path, schema), keys).write.mode("overwrite").partitionBy(
        *partition_by, ATTEMPT).parquet(out_path)
