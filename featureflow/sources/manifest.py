"""Tab-separated manifests (person, image id, face id, url, box, checksum)."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Fixed value: the manifest columns, in file order.
MANIFEST_COLUMNS = ["name", "image_id", "face_id", "url", "bbox", "sha256"]
MANIFEST_SCHEMA = ", ".join(f"{c} string" for c in MANIFEST_COLUMNS)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works for
    local, HDFS and object stores alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) or bool(fs.globStatus(p))


def _read_by_line(spark: SparkSession, paths: list[str], sep: str, header: bool, with_source: bool) -> DataFrame:
    """Lines split on ``sep`` by position; a line without exactly six fields is
    ``malformed`` (every field is read, so the check holds under any later
    column pruning). A header line (the fixed column names) is skipped."""
    lines = spark.read.text(paths)
    if with_source:
        lines = lines.withColumn("source_file", F.col("_metadata.file_path"))
    if header:
        lines = lines.filter(F.col("value") != F.lit(sep.join(MANIFEST_COLUMNS)))
    lines = lines.filter(F.length("value") > 0)
    parts = F.split(F.col("value"), sep, -1)
    fields = [F.try_element_at(parts, F.lit(i + 1)).alias(c) for i, c in enumerate(MANIFEST_COLUMNS)]
    status = F.when(F.size(parts) == len(MANIFEST_COLUMNS), F.lit("ok")).otherwise(F.lit("malformed"))
    extra = ["source_file"] if with_source else []
    df = lines.select(*fields, *extra, status.alias("status"))
    # empty fields read as NULL, as in the CSV reader
    return df.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in MANIFEST_COLUMNS], *extra, "status")


def read_manifest(
    spark: SparkSession,
    paths: str | Sequence[str],
    missing: str = "skip",
    with_source: bool = False,
    sep: str = "\t",
    header: bool = True,
    malformed: str = "pad",
) -> DataFrame:
    """One scan of all manifest files with a fixed all-string schema.

    Fields are read by position; ``image_id`` becomes ``bigint`` by
    ``try_cast`` (non-numeric or empty -> NULL, never an error). A row with
    the wrong number of fields is padded with NULLs (``malformed="pad"``),
    kept with ``status = 'malformed'`` (``"flag"``) or dropped (``"drop"``).
    A missing file is skipped with a warning (``missing="skip"``) or raises
    (``"error"``). ``with_source`` adds the file each row came from.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = []
    for p in paths:
        if path_exists(spark, p):
            found.append(p)
        elif missing == "error":
            raise FileNotFoundError(p)
        else:
            log.warning("manifest not found, skipped: %s", p)
    if not found:
        df = spark.createDataFrame([], MANIFEST_SCHEMA)
        if with_source:
            df = df.withColumn("source_file", F.lit(None).cast("string"))
        if malformed == "flag":
            df = df.withColumn("status", F.lit(None).cast("string"))
    elif malformed == "pad":
        reader = spark.read.schema(MANIFEST_SCHEMA).option("sep", sep).option("header", header)
        df = reader.option("mode", "PERMISSIVE").csv(found)
        if with_source:
            df = df.withColumn("source_file", F.col("_metadata.file_path"))
    else:
        df = _read_by_line(spark, found, sep, header, with_source)
        if malformed == "drop":
            df = df.filter(F.col("status") == "ok").drop("status")
    return df.withColumn("image_id", F.col("image_id").try_cast("bigint"))
