"""Label files: JSON records ``{image_path, emotion}`` or ``{image_path, error}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featureflow.sources.json_array import read_json_array

# Fixed value: label record fields (a record carries ``emotion`` or ``error``).
LABELS_SCHEMA = "image_path string, emotion string, error string"


def read_labels(spark: SparkSession, path: str | list[str], multiline: bool = True,
                parallel: bool = False) -> DataFrame:
    """Explicit schema, so a file where no record has ``error`` still has the
    column (NULL) and the filters on it resolve. ``multiline=True`` reads files
    holding one JSON array, a task a file, or many with ``parallel`` (two passes);
    ``False`` reads JSON lines (splittable)."""
    if multiline and parallel:
        return read_json_array(spark, path, LABELS_SCHEMA)
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(LABELS_SCHEMA).option("multiLine", multiline).json(paths)
