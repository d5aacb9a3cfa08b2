"""Vector files ``<root>/<person>/<id>.npy`` as a feature table.

One Spark ``binaryFile`` scan lists and reads the files on the executors; an
Arrow-batched ``mapInPandas`` stage parses each file with ``np.load`` (no
pickles). A file that is empty, not numeric or not 1-D gets a status instead
of failing the job.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions import paths as P
from featureflow.operators.columns import OK

VECTOR_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("person", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("features", T.ArrayType(T.FloatType())),
    T.StructField("status", T.StringType()),
])


def parse_vector(content: bytes) -> tuple[np.ndarray | None, str]:
    try:
        arr = np.load(io.BytesIO(content), allow_pickle=False)
    except Exception as e:  # noqa: BLE001 - a bad file is a row status
        return None, f"unreadable: {type(e).__name__}"
    if arr.dtype.kind not in "iuf":
        return None, "not_numeric"
    if arr.ndim != 1:
        arr = arr.reshape(-1) if arr.ndim > 1 and arr.shape[0] == 1 else arr
        if arr.ndim != 1:
            return None, "not_1d"
    if arr.size == 0:
        return None, "empty"
    return arr.astype(np.float32), OK


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        feats = np.empty(len(pdf), dtype=object)
        status = np.empty(len(pdf), dtype=object)
        for i, content in enumerate(pdf["content"]):
            feats[i], status[i] = parse_vector(content)
        yield pd.DataFrame({"path": pdf["path"], "person": pdf["person"], "filename": pdf["filename"],
                            "features": feats, "status": status})


def read_vector_files(spark: SparkSession, root: str, extension: str = ".npy") -> DataFrame:
    """``path, person, filename, image_id, features array<float>, status``."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{extension}")
        .load(root)
    )
    p = P.strip_scheme(F.col("path"))
    named = files.select(p.alias("path"), P.parent_folder(p).alias("person"),
                         P.base_name(p).alias("filename"), "content")
    parsed = named.mapInPandas(_parse, VECTOR_SCHEMA)
    return parsed.withColumn("image_id", P.stem(F.col("filename")).try_cast("bigint"))
