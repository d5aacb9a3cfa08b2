"""Incremental sample building with Structured Streaming.

The original builds its training table in batches of 500 label records and
skips the work when the output folder exists, so a crash mid-run looks like a
finished run. Here new label files are picked up as a file stream, joined to
the (static) feature table and appended to the sample table. The checkpoint
records which files are done, and the file sink commits each micro-batch
atomically, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from featureflow.operators import columns, joins
from featureflow.session import checkpoint_dir
from featureflow.sources.labels import LABELS_SCHEMA

KEY = ["person", "image_id"]


def label_stream(spark: SparkSession, labels_dir: str, max_files_per_trigger: int | None = None,
                 multiline: bool = True) -> DataFrame:
    """New JSON label files in ``labels_dir`` as a stream (fixed schema)."""
    reader = spark.readStream.schema(LABELS_SCHEMA).option("multiLine", multiline)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.json(labels_dir)


def parquet_stream(spark: SparkSession, folder: str, schema: str, glob: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in ``folder`` (optionally only names matching ``glob``)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(folder)


def append_stream(stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to Parquet with a checkpoint. ``available_now`` processes
    what is there and stops (a scheduled batch run); otherwise it keeps running."""
    w = (stream.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def join_stream(stream: DataFrame, static: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Stream-static inner join (the static side is re-read per micro-batch, so
    it may itself be a growing table)."""
    return joins.join_labels(stream, static, on)


def stream_samples(
    spark: SparkSession,
    labels_dir: str,
    features: DataFrame,
    out_path: str,
    checkpoint: str,
    mapping: Mapping[str, int] | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the query: label files -> valid -> (person, id) -> code -> join
    features -> append Parquet. ``features`` is a static table with
    ``person, image_id, features``."""
    labs = columns.valid_labels(label_stream(spark, labels_dir, max_files_per_trigger))
    labs = columns.with_path_parts(labs, "image_path")
    labs = labs.select(F.col("parent").alias("person"), F.col("stem").try_cast("bigint").alias("image_id"),
                       "emotion")
    labs = columns.encode_label(labs, "emotion", mapping)
    samples = joins.join_features(labs, features.select(*KEY, "features"), KEY)
    return append_stream(samples.select(*KEY, "label", "features"), out_path, checkpoint, available_now)


def run_to_table(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run ``stream`` over everything available into a fresh folder under the
    session's shared checkpoint folder and return the written table."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"
    q = append_stream(stream, f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
