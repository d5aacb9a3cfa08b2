"""Row-local operators (projections, filters, scalar columns).

Every function is ``DataFrame -> DataFrame`` and builds native Catalyst
expressions only, so the filters push down into the scan and the columns stay
inside whole-stage codegen. No Python runs per row here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.functions import bbox as _bbox
from featureflow.functions import labels as _labels
from featureflow.functions import paths as _paths

OK = "ok"


# ---------------------------------------------------------------- status convention

def with_status(df: DataFrame, failed: Column, reason: str, status_col: str = "status") -> DataFrame:
    """Mark rows where ``failed`` holds with ``reason``, unless an earlier stage
    already failed them (first failure wins). Rows never fail a task."""
    current = F.col(status_col) if status_col in df.columns else F.lit(OK)
    hit = F.coalesce(failed, F.lit(False))
    return df.withColumn(status_col, F.when((current == OK) & hit, F.lit(reason)).otherwise(current))


def drop_failed(df: DataFrame, status_col: str = "status") -> DataFrame:
    """Keep only rows whose status is ``ok``."""
    return df.filter(F.col(status_col) == OK)


# ---------------------------------------------------------------- labels

def valid_labels(df: DataFrame, label_col: str = "emotion", error_col: str = "error") -> DataFrame:
    """Label records that carry a label and no error."""
    return df.filter(F.col(error_col).isNull() & F.col(label_col).isNotNull())


def encode_label(
    df: DataFrame,
    label_col: str = "emotion",
    mapping: Mapping[str, int] | DataFrame | None = None,
    out: str = "label",
    keep_unknown: bool = False,
) -> DataFrame:
    """Class name -> code; NULL or unmapped names get -1 and are dropped
    unless ``keep_unknown``.

    ``mapping`` is a dict (a literal map in the plan) or a two-column DataFrame
    ``(name, code)`` of any size, which is joined. A name with two codes raises.
    """
    if mapping is None:
        mapping = _labels.EMOTION_CODES
    if isinstance(mapping, DataFrame):
        codes = mapping_table(mapping)
        joined = df.join(codes, F.col(label_col) == F.col("__map_name"), "left" if keep_unknown else "inner")
        code = F.coalesce(F.col("__map_code"), F.lit(_labels.UNKNOWN_CODE))
        return joined.withColumn(out, code).drop("__map_name", "__map_code")
    out_df = df.withColumn(out, _labels.label_code(F.col(label_col), mapping))
    return out_df if keep_unknown else out_df.filter(F.col(out) >= 0)


def mapping_table(mapping: DataFrame) -> DataFrame:
    """``__map_name, __map_code`` of a ``(name, code)`` table, each name once.
    Repeated rows are merged only if there are any: a join on the raw table is
    one that AQE can split."""
    name, code = (F.col(c) for c in mapping.columns[:2])
    rows = mapping.select(name.alias("__map_name"), code.cast("int").alias("__map_code")).filter(name.isNotNull())
    each = rows.groupBy("__map_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("__map_code").alias("lo"), F.max("__map_code").alias("hi"))
    n, clash = each.agg(F.max("n"), F.max(F.when(F.col("lo") != F.col("hi"), F.col("__map_name")))).first()
    if clash is not None:
        raise ValueError(f"label {clash!r} maps to more than one code")
    return rows.distinct() if (n or 0) > 1 else rows


def class_codes(df: DataFrame, name_col: str) -> DataFrame:
    """``name, code``: codes ``0..k-1`` for the distinct non-NULL names of
    ``name_col``, in name order. The names come from a partial aggregate and
    are numbered by ranges, so no single task sorts them all."""
    from featureflow.operators.splits import with_batch_id

    names = df.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
    return with_batch_id(names, "name", 1, out="__batch", index_col="code").select(
        "name", F.col("code").cast("int").alias("code"))


# ---------------------------------------------------------------- ids, names, paths

def with_image_id(
    df: DataFrame, path_col: str = "image_path", pattern: str = _paths.IMAGE_ID_PATTERN,
    out: str = "image_id", to: str = "bigint",
) -> DataFrame:
    """Numeric id from the path; no match or a bad number gives NULL (never an error)."""
    return df.withColumn(out, _paths.image_id(F.col(path_col), pattern, to))


def normalize_name(df: DataFrame, col: str = "name", out: str | None = None) -> DataFrame:
    """Spaces in ``col`` become underscores (folder-safe person names)."""
    return df.withColumn(out or col, _paths.normalized_name(F.col(col)))


def with_path_parts(df: DataFrame, path_col: str = "path", prefix: str = "") -> DataFrame:
    """Adds ``parent`` (second-to-last segment), ``base_name``, ``stem``, ``ext``."""
    p = F.col(path_col)
    name = _paths.base_name(p)
    return df.select(
        "*",
        _paths.parent_folder(p).alias(f"{prefix}parent"),
        name.alias(f"{prefix}base_name"),
        _paths.stem(name).alias(f"{prefix}stem"),
        _paths.extension(name).alias(f"{prefix}ext"),
    )


def with_image_path(
    df: DataFrame, root: str, person_col: str = "name", id_col: str = "image_id",
    out: str = "image_path", ext: str = ".jpg",
) -> DataFrame:
    """``<root>/<person>/<id><ext>``, the layout images are stored under."""
    return df.withColumn(out, _paths.image_path(root, F.col(person_col), F.col(id_col), ext))


def filter_files(df: DataFrame, name_col: str = "base_name", extensions: Sequence[str] = (".npy",)) -> DataFrame:
    """Keep visible files (no leading dot) with one of ``extensions``."""
    return df.filter(_paths.is_visible_file(F.col(name_col), extensions))


# ---------------------------------------------------------------- bbox

def parse_bbox(
    df: DataFrame, col: str = "bbox", out: str = "bbox_coords", status_col: str = "status",
) -> DataFrame:
    """``"x1,y1,x2,y2"`` -> ``array<int>``; anything but four integers gives
    NULL and ``status = 'bad_bbox'`` instead of a failed job."""
    parts = _bbox.bbox_parts(F.col(col))
    tmp = f"__{out}_parts"
    parsed = df.withColumn(tmp, parts)
    ok = _bbox.bbox_ok(F.col(tmp))
    parsed = parsed.withColumn(out, F.when(ok, F.col(tmp)))
    parsed = with_status(parsed, ~ok, "bad_bbox", status_col)
    return parsed.drop(tmp)


# ---------------------------------------------------------------- vectors

def usable_vector(col: str, dim: int) -> Column:
    """True for an array of ``dim`` components, none NULL, NaN or infinite."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(col) == dim) & ~bad, F.lit(False))


def vector_dim(df: DataFrame, array_col: str = "features") -> int:
    """The most frequent vector length (the larger of equals); raises without any vector."""
    row = (df.filter(F.size(array_col) > 0).groupBy(F.size(array_col).alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.desc("d")).first())
    if row is None:
        raise ValueError("input is empty: no vectors")
    return int(row["d"])


def with_vector_status(df: DataFrame, array_col: str = "features", dim: int | None = None,
                       status_col: str = "status") -> DataFrame:
    """``bad_vector`` for rows whose vector is NULL, of another length or not finite."""
    dim = dim or vector_dim(df, array_col)
    return with_status(df, ~usable_vector(array_col, dim), "bad_vector", status_col)


def with_vector(df: DataFrame, array_col: str = "features", vector_col: str = "features_vector",
                dim: int | None = None) -> DataFrame:
    """``array<float|double>`` -> ML ``DenseVector`` column (JVM function, no
    Python UDF). Idempotent: an existing ``vector_col`` is kept. With ``dim`` a
    vector that isn't usable becomes zeros, as ML models fail on NULL; callers
    blank the outputs of those rows (``usable_vector``)."""
    from pyspark.ml.functions import array_to_vector

    if vector_col in df.columns:
        return df
    col = F.col(array_col)
    if dim is not None:
        zero = F.lit(0).cast(df.schema[array_col].dataType.elementType)
        col = F.when(usable_vector(array_col, dim), col).otherwise(F.array_repeat(zero, dim))
    return df.withColumn(vector_col, array_to_vector(col))
