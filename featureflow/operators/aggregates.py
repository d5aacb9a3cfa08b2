"""Roll-ups: counts per split, per status, number of classes.

One grouped aggregate replaces a chain of ``count()`` jobs; every aggregate
here combines partially on the map side, so a hot group (one split or one
status holding most rows) costs one partial row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.operators.columns import OK


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """``split, n`` in one job (instead of one count per split)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def status_summary(df: DataFrame, status_col: str = "status") -> DataFrame:
    """``status, n`` over all rows, failures included."""
    return df.groupBy(status_col).agg(F.count(F.lit(1)).alias("n"))


def require_ok(summary: DataFrame, status_col: str = "status") -> dict[str, int]:
    """``{"ok": n, "failed": n}`` of a status summary; raises when the stage had
    rows but none of them succeeded (naming the most frequent statuses), or had
    no rows at all. Any number of statuses: only two sums are read."""
    good = F.col(status_col) == OK
    ok, failed = summary.agg(F.sum(F.when(good, F.col("n"))), F.sum(F.when(~good | good.isNull(), F.col("n")))).first()
    counts = {OK: int(ok or 0), "failed": int(failed or 0)}
    if not sum(counts.values()):
        raise ValueError("stage produced no rows")
    if not counts[OK]:
        top = {r[status_col]: r["n"] for r in summary.orderBy(F.desc("n"), status_col).limit(5).collect()}
        raise ValueError(f"stage produced no usable row: {top}")
    return counts


def num_classes(df: DataFrame, label_col: str = "label") -> DataFrame:
    """One row: number of distinct labels."""
    return df.agg(F.countDistinct(label_col).alias("n_classes"))


def require_rows(df: DataFrame, what: str = "training input") -> None:
    """Raise on an empty input (one bounded job)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
