"""Image folders ``<root>/<person>/<id>.<ext>``: listings and decoded pictures.

Listing and decoding are Spark file sources. Large folders are walked by tasks,
but the result, one file status per picture, is held by the driver: split a
collection of more than some 10^8 files into folders and runs. Hidden files
(leading ``.`` or ``_``) are skipped by Spark itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import paths as P
from featureflow.operators.columns import OK

# Fixed value: the picture extensions of the original listing.
IMAGE_EXTENSIONS = (".jpg", ".png")


def _glob(exts: Sequence[str]) -> str:
    names = ",".join(e.lstrip(".") for e in exts)
    return f"*.{{{names}}}" if len(exts) > 1 else f"*.{names}"


def _with_parts(df: DataFrame, path_col: str = "path") -> DataFrame:
    p = F.col(path_col)
    name = P.base_name(p)
    return df.select(
        "*",
        P.parent_folder(p).alias("person"),
        name.alias("filename"),
        P.stem(name).try_cast("bigint").alias("image_id"),
    )


def list_images(
    spark: SparkSession, root: str, extensions: Sequence[str] = IMAGE_EXTENSIONS, require_any: bool = True,
) -> DataFrame:
    """``path, length, modificationTime, person, filename, image_id`` of every
    picture under ``root`` (recursive). File contents are not read. Raises when
    nothing is found and ``require_any``."""
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _glob(extensions))
        .load(root)
        .select(P.strip_scheme(F.col("path")).alias("path"), "length", "modificationTime")
    )
    if require_any and df.isEmpty():
        raise FileNotFoundError(f"no {'/'.join(extensions)} files under {root}")
    return _with_parts(df)


def read_images(
    spark: SparkSession, root: str, drop_invalid: bool = False, extensions: Sequence[str] = IMAGE_EXTENSIONS,
) -> DataFrame:
    """Decoded pictures (Spark ``image`` source, BGR byte order) with
    ``path, person, filename, image_id`` and ``status``: a file that does not
    decode is ``undecodable`` (or dropped with ``drop_invalid``)."""
    df = (
        spark.read.format("image")
        .option("dropInvalid", drop_invalid)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _glob(extensions))
        .load(root)
    )
    df = df.select(P.strip_scheme(F.col("image.origin")).alias("path"), "image")
    df = _with_parts(df)
    bad = F.col("image").isNull() | (F.col("image.height") < 0)
    return df.withColumn("status", F.when(bad, F.lit("undecodable")).otherwise(F.lit(OK)))
