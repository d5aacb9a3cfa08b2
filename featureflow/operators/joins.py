"""Keyed joins, presence checks and unions.

Joins are declared on explicit keys and left to Catalyst + AQE: sort-merge by
default, turned into a broadcast at run time when a side turns out small, and
skewed partitions split by AQE's skew-join rule. No side is broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join_labels(
    labels: DataFrame,
    manifest: DataFrame,
    on: str | Sequence[str] = ("person", "image_id"),
    how: str = "inner",
    unique: bool = False,
) -> DataFrame:
    """Label records x manifest rows on ``on``.

    The default key names the person too: image ids repeat across people. NULL
    keys never match. Repeated keys multiply, as in any equi-join; with
    ``unique=True`` a repeated manifest key raises instead.
    """
    keys = _keys(on)
    if unique:
        _raise_if_repeated(manifest, keys, "manifest key")
    return labels.join(manifest, keys, how)


def _raise_if_repeated(df: DataFrame, keys: list[str], what: str) -> None:
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what} repeated: {dict(zip(keys, dup[0][:-1]))}")


def join_features(
    labels: DataFrame, features: DataFrame, on: Sequence[str] = ("person", "image_id"),
) -> DataFrame:
    """Labels x feature rows on a composite key; keeps only labels whose
    feature row exists (inner join)."""
    return labels.join(features, _keys(on), "inner")


def with_presence(
    df: DataFrame, files: DataFrame, on: str | Sequence[str], out: str = "present",
) -> DataFrame:
    """Adds boolean ``out``: does a row of ``files`` have the same key?

    A semi join and an anti join on the raw keys, put together: repeated keys
    on the right never multiply rows, and AQE can split a hot key of either
    join (a join on aggregated keys it can't).
    """
    keys = _keys(on)
    marks = files.select(*keys)
    return (df.join(marks, keys, "left_semi").withColumn(out, F.lit(True))
            .unionByName(df.join(marks, keys, "left_anti").withColumn(out, F.lit(False))))


def present_only(df: DataFrame, files: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key exists in ``files`` (``EXISTS``, left-semi)."""
    keys = _keys(on)
    return df.join(files.select(*keys), keys, "left_semi")


def pending(todo: DataFrame, done: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``todo`` not done yet (``NOT EXISTS``, left-anti)."""
    keys = _keys(on)
    return todo.join(done.select(*keys), keys, "left_anti")


def attach_names(
    points: DataFrame, names: DataFrame, on: str | Sequence[str] = "sample_id",
) -> DataFrame:
    """Coordinates + names by key, with the length guard of the original as a
    per-key guard: a name key that points use twice raises here, a point
    without a name raises at run time."""
    keys = _keys(on)
    # repeated keys that some point asks for: grouped counts, so a hot key is one
    # partial row per task, and only repeated keys meet the points
    twice = names.groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)
    asked = points.select(*keys).join(twice, keys, "left_semi").limit(1).collect()
    if asked:
        raise ValueError(f"name key repeated: {asked[0].asDict()}")
    # raw tables on both sides, so AQE can split a hot key; a filter (not a
    # dropped column) keeps the optimizer from pruning the guard, and a left
    # join keeps unnamed points until it sees them
    guard = F.when(F.col("__named").isNull(), F.raise_error(F.lit("point without a name"))).otherwise(F.lit(True))
    return points.join(names.withColumn("__named", F.lit(True)), keys, "left").filter(guard).drop("__named")


def union_manifests(*dfs: DataFrame, sources: Sequence[str] | None = None, source_col: str = "source") -> DataFrame:
    """Union by column name; columns missing on one side become NULL.
    ``sources`` tags each input's rows (one scan of all inputs, no loop)."""
    if not dfs:
        raise ValueError("nothing to union")
    tagged = list(dfs)
    if sources is not None:
        if len(sources) != len(dfs):
            raise ValueError("one source name per input")
        tagged = [d.withColumn(source_col, F.lit(s)) for d, s in zip(dfs, sources)]
    out = tagged[0]
    for d in tagged[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
