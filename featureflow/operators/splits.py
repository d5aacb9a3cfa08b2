"""Reproducible splits and fixed-size batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.functions.hashing import BUCKETS, split_bucket, split_label
from featureflow.session import materialize

# Split presets of the original pipeline.
SPLIT_75_15_10 = {"train": 0.75, "val": 0.15, "test": 0.10}
SPLIT_70_20_10 = {"train": 0.70, "eval": 0.20, "test": 0.10}
SPLIT_70_15_15 = {"train": 0.70, "val": 0.15, "test": 0.15}


def hash_split(
    df: DataFrame,
    key: str | list[str],
    weights: dict[str, float] | None = None,
    seed: int = 0,
    out: str = "split",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Tag every row with a split name chosen by a hash of ``key``.

    Membership depends on the key only: the same rows land in the same split
    whatever the partitioning, the number of executors or task retries, and no
    shuffle is needed. A NULL key raises.
    """
    weights = weights or SPLIT_75_15_10
    if isinstance(key, str):
        k = F.col(key)
    else:  # composite key: its parts joined by '/' (NULL if any part is NULL)
        k = F.concat(*[p for c in key for p in (F.lit("/"), F.col(c).cast("string"))][1:])
    # the bucket is its own column so the md5 is computed once per row, not
    # once per CASE branch
    tagged = df.withColumn("__bucket", split_bucket(k, seed, buckets))
    return tagged.withColumn(out, split_label(F.col("__bucket"), weights, buckets)).drop("__bucket")


#: A key's hash for exact splits: four digits of 15 bits.
DIGIT_BITS, HASH_BITS = 15, 60


def exact_split(
    df: DataFrame,
    key: str | list[str],
    weights: dict[str, float] | None = None,
    by: str | None = None,
    seed: int = 0,
    out: str = "split",
) -> DataFrame:
    """Tag every row with a split name, with exact split sizes, in every class of
    ``by`` if given (NULL is a class).

    Rows of a class are put in order of a hash of ``key``; the first
    ``round(weight * rows)`` make the first split, and so on. Rows of one key
    have one place, that of the first of them, and so stay together: with
    repeated keys a split may end later by the rows of its last key. Membership
    doesn't depend on the partitioning. A NULL key raises.

    No sort: the hash at each border is found digit by digit from grouped counts,
    2^15 a class at most, which combine on the map side, so a hot class or key
    costs a row per task. Two narrow passes over the key and class columns, one
    of them for the few rows that share a border's first digit.
    """
    weights = weights or SPLIT_75_15_10
    names, total = list(weights), float(sum(weights.values()))
    if total <= 0 or any(w < 0 for w in weights.values()):
        raise ValueError(f"bad split weights {weights}")
    shares, run = [], 0.0
    for name in names[:-1]:
        run += weights[name]
        shares.append(run / total)
    parts = [key] if isinstance(key, str) else list(key)
    text = F.concat(*[p for c in parts for p in (F.lit("/"), F.col(c).cast("string"))][1:])
    hashed = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text) if seed else text), 1, HASH_BITS // 4), 16, 10)
    place = F.when(text.isNull(), F.raise_error(F.lit("split key is NULL")).cast("bigint")).otherwise(hashed.cast("bigint"))
    tagged = df.withColumn("__h", place).withColumn("__c", F.col(by) if by else F.lit(0))
    if not shares:
        return tagged.withColumn(out, F.when(F.col("__h").isNotNull(), F.lit(names[0]))).drop("__h", "__c")
    rows, left = tagged.select("__c", "__h"), HASH_BITS - DIGIT_BITS
    n, below = F.col("__n"), F.coalesce(F.sum("__n").over(
        Window.partitionBy("__c", "__i").orderBy("__d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    borders = F.array(*[F.struct(F.lit(i).alias("__i"), F.lit(s).alias("__share")) for i, s in enumerate(shares)])
    # the row at a class's border: the digit that holds it, and the rows before that digit
    counts = rows.groupBy("__c", F.shiftright("__h", left).alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumn("__all", F.sum("__n").over(Window.partitionBy("__c")))
    counts = counts.select("*", F.inline(borders)).withColumn("__at", F.floor(F.col("__share") * F.col("__all") + 0.5))
    found = counts.withColumn("__below", below).filter((F.col("__below") <= F.col("__at")) & (F.col("__at") < F.col("__below") + n))
    found = materialize(found.select("__c", "__i", "__at", F.col("__d").alias("__prefix"), "__below"))
    state = found.select(F.col("__c").alias("__k"), F.col("__i").alias("__j"), "__at", "__prefix", "__below")
    near = rows.join(state, F.col("__c").eqNullSafe(F.col("__k")) & (F.shiftright("__h", left) == F.col("__prefix")))
    near = materialize(near.groupBy("__c", F.col("__j").alias("__i"), "__h").agg(F.count(F.lit(1)).alias("__n")))
    while left:
        here = near.join(state, F.col("__c").eqNullSafe(F.col("__k")) & (F.col("__i") == F.col("__j"))
                         & (F.shiftright("__h", left) == F.col("__prefix")))
        left -= DIGIT_BITS
        digit = F.shiftright("__h", left).alias("__d")
        here = here.groupBy("__c", "__i", "__at", F.col("__below").alias("__before"), digit).agg(F.sum("__n").alias("__n"))
        here = here.withColumn("__below", F.col("__before") + below).filter(
            (F.col("__below") <= F.col("__at")) & (F.col("__at") < F.col("__below") + n))
        state = here.select(F.col("__c").alias("__k"), F.col("__i").alias("__j"), "__at", F.col("__d").alias("__prefix"), "__below")
    # rows of a key that began before the border stay before it
    border = F.col("__prefix") + F.when(F.col("__below") < F.col("__at"), 1).otherwise(0)
    borders = state.groupBy("__k").agg(*[F.max(F.when(F.col("__j") == i, border)).alias(f"__b{i}") for i in range(len(shares))])
    joined = tagged.join(borders, F.col("__c").eqNullSafe(F.col("__k")), "left")
    label = F.lit(names[-1])
    for i in range(len(shares) - 1, -1, -1):  # no border: the class ends before it
        label = F.when(F.col(f"__b{i}").isNull() | (F.col("__h") < F.col(f"__b{i}")), F.lit(names[i])).otherwise(label)
    return joined.select(*df.columns, label.alias(out)) if out not in df.columns else joined.withColumn(out, label).select(*df.columns)


def split_frames(df: DataFrame, split_col: str = "split", names: list[str] | None = None) -> dict[str, DataFrame]:
    """One filtered frame per split name (each a pushed-down filter, not a job)."""
    names = names or list(SPLIT_75_15_10)
    return {n: df.filter(F.col(split_col) == n) for n in names}


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """Spark's ``randomSplit`` (membership moves with partitioning; prefer ``hash_split``)."""
    return df.randomSplit(weights, seed)


def with_batch_id(
    df: DataFrame,
    order_by: list[str] | str,
    size: int,
    out: str = "batch_id",
    index_col: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """``batch_id = floor(position / size)`` where position is the 0-based rank
    of the row in ``order_by`` order. Keys may repeat and be NULL (first); rows
    of one key take its positions in no particular order.

    Rows are counted by key, so a hot key is a partial count per task. The
    different keys are range-partitioned and written once to the shared
    checkpoint folder (range bounds come from a random sample, so two reads of a
    range shuffle need not agree); a key's first position is the rows before it
    in its range plus those of the ranges before (one row per range). Rows are
    joined to their key's first position. Those of repeated keys are written
    once in slices of their input partitions, and each slice of a key is numbered
    on its own after the slices before it, so no task gets a whole hot key.
    """
    if size <= 0:
        raise ValueError("batch size must be positive")
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranged = materialize(
        df.groupBy(*order).agg(F.count(F.lit(1)).alias("__rows")).repartitionByRange(n, *order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__local", F.coalesce(F.sum("__rows").over(before), F.lit(0))))
    counts = ranged.groupBy("__pid").agg(F.sum("__rows").alias("__n"))
    offsets = counts.select(
        "__pid", F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)).alias("__off"))
    # one row per range: the broadcast side is bounded by n
    places = ranged.join(F.broadcast(offsets), "__pid").select(
        *[F.col(c).alias(f"__key_{c}") for c in order], "__rows",
        (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local")).alias("__pos"))
    same = None
    for c in order:
        hit = F.col(c).eqNullSafe(F.col(f"__key_{c}"))
        same = hit if same is None else same & hit
    keys = [f"__key_{c}" for c in order]
    repeated = ranged.filter("__rows > 1")
    if repeated.isEmpty():
        res = df.join(places, same).drop("__rows")
    else:
        res = df.join(places.filter("__rows = 1"), same).drop("__rows").unionByName(
            _slots(df.join(places.filter("__rows > 1"), same).drop("__rows"), keys))
    res = res.withColumn(out, F.expr(f"__pos div {int(size)}"))
    res = res.withColumnRenamed("__pos", index_col) if index_col else res.drop("__pos")
    return res.drop(*keys)


#: Rows of a partition that make a slice.
SLICE_ROWS = 1 << 17


def _slots(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add to ``__pos``, the first position of a row's key, the row's place within
    the key. Rows are written once, numbered as they come; the places of a slice
    follow those of the key's earlier slices."""
    rid = F.monotonically_increasing_id()
    cut = materialize(rows.withColumn("__rid", rid).withColumn("__slice", F.expr(f"__rid div {SLICE_ROWS}")))
    sizes = cut.groupBy("__pos", "__slice").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__pos").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("__pos").alias("__first"), F.col("__slice").alias("__part"),
                         F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__skip"))
    place = F.row_number().over(Window.partitionBy("__pos", "__slice").orderBy("__rid")) - 1
    numbered = cut.withColumn("__place", place)
    return numbered.join(sizes, (F.col("__pos") == F.col("__first")) & (F.col("__slice") == F.col("__part"))).withColumn(
        "__pos", F.col("__pos") + F.col("__skip") + F.col("__place")).drop(
        "__rid", "__slice", "__first", "__part", "__skip", "__place")
