"""Deterministic per-row buckets for splits.

A bucket depends only on the key value, never on partitioning, task order or
retries, so a split is the same on 8 threads and on 1000 executors, and a
re-run task puts every row back in the same split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1000


def split_bucket(key: Column, seed: int = 0, buckets: int = BUCKETS) -> Column:
    """``conv(first 7 hex digits of md5(str(key)), 16, 10) % buckets``.

    ``seed`` 0 hashes the key text alone; any other seed prefixes ``"<seed>:"``.
    A NULL key raises at run time: it has no place in any split.
    """
    text = key.cast("string")
    if seed:
        text = F.concat(F.lit(f"{seed}:"), text)
    bucket = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint") % F.lit(buckets)
    return F.when(key.isNull(), F.raise_error(F.lit("split key is NULL")).cast("bigint")).otherwise(bucket)


def cut_points(weights: dict[str, float], buckets: int = BUCKETS) -> list[tuple[str, int]]:
    """Running sums of normalised weights, as bucket bounds (exclusive). A split
    too small for its own bucket raises; use more ``buckets`` (up to 2**28)."""
    total = float(sum(weights.values()))
    if total <= 0 or any(w < 0 for w in weights.values()):
        raise ValueError(f"bad split weights {weights}")
    out, run, last = [], 0.0, 0
    for name, w in weights.items():
        run += w / total
        bound = int(round(run * buckets))
        if w > 0 and bound == last:
            raise ValueError(f"split {name!r} gets none of {buckets} buckets")
        out.append((name, bound))
        last = bound
    out[-1] = (out[-1][0], buckets)
    return out


def split_label(bucket: Column, weights: dict[str, float], buckets: int = BUCKETS) -> Column:
    cuts = cut_points(weights, buckets)
    expr = None
    for name, bound in cuts[:-1]:
        expr = (F.when(bucket < bound, F.lit(name)) if expr is None
                else expr.when(bucket < bound, F.lit(name)))
    last = F.lit(cuts[-1][0])
    return last if expr is None else expr.otherwise(last)
