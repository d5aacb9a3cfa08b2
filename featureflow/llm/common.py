"""Helpers shared by the operators here: tables cut into the shared folder,
whole groups out of sorted Arrow batches, spanning forests, connected
components, distributed ranks."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureflow.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Cuts:
    """Intermediate tables of one operator call, as Parquet in the shared
    checkpoint folder. A table read back has no lineage: a lost executor costs
    only its running tasks, and later joins plan with the table's real size.

    >>> with Cuts(spark) as cuts:
    ...     a = cuts.save(a)           # the table stays after the block
    ...     b = cuts.save(b, keep=False)   # removed when the block ends
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self._drop: list[str] = []

    def save(self, df: DataFrame, keep: bool = True) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        if not keep:
            self._drop.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        for p in self._drop:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self._drop = []

    def free(self) -> None:
        """Let the driver notice the shuffles that nothing refers to any more, so
        that executors delete their files."""
        for _ in range(2):  # Python lets go of Java's objects a moment after its own
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.3)

    def __enter__(self) -> Cuts:
        return self

    def __exit__(self, *exc) -> None:
        self.drop()


def spare_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"{base}_"
    return base


# ------------------------------------------------------------------ whole groups from sorted batches

def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup batches that are sorted by ``keys`` so that no group is cut: each
    table holds complete groups only. Holds one batch and one group at most."""
    held: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        last = group_starts([t.column(k) for k in keys])[-1]
        if last:
            yield t.slice(0, last).combine_chunks()
        held = t.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def group_starts(columns) -> np.ndarray:
    """Row numbers at which a new group begins, for key columns in sorted order."""
    new = None
    for c in columns:
        v = c.to_numpy() if isinstance(c, (pa.ChunkedArray, pa.Array)) else np.asarray(c)
        diff = v[1:] != v[:-1]
        new = diff if new is None else new | diff
    return np.concatenate([[0], np.flatnonzero(new) + 1]) if len(new) else np.array([0])


def pairs_by_offset(starts: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row-number pairs (i, j), i < j, of every group, one distance j - i at a
    time. Rows of finished groups leave, so the work is the number of pairs."""
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    rows = np.arange(n)
    d = 1
    while True:
        rows = rows[rows + d < ends[rows]]
        if not len(rows):
            return
        yield rows, rows + d
        d += 1


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) for the links a[i]-b[i]:
    one per node, however many links there are."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        m = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, m)
        np.minimum.at(new, y, m)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


# ------------------------------------------------------------------ hot buckets in blocks

def spread_blocks(cuts: Cuts, rows: DataFrame, bucket: list[str], member: str, block_rows: int) -> DataFrame:
    """Add ``cell_i``, ``cell_j`` (and ``own``) so that the members of each bucket
    meet in cells of at most about 2 x ``block_rows`` rows.

    A bucket of up to ``block_rows`` members is one cell. A larger one is cut
    into n blocks by a hash of ``member`` and each pair of blocks is a cell, so
    every two members still meet in exactly one cell (members of the same
    block: in the cell (i, i)). ``own`` is the member's block. Nothing is
    capped; a hot bucket's work is spread over n(n+1)/2 tasks.
    """
    big = cuts.save(rows.groupBy(*bucket).count().filter(F.col("count") > block_rows)
                    .select(*bucket, F.ceil(F.col("count") / block_rows).cast("int").alias("n_blocks")))
    rows = rows.join(big, bucket, "left")
    own = F.pmod(F.xxhash64(F.col(member), F.lit("block")), F.col("n_blocks")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda j: F.struct(F.least(F.col("own"), j).alias("cell_i"), F.greatest(F.col("own"), j).alias("cell_j")))
    one = F.array(F.struct(F.lit(0).alias("cell_i"), F.lit(0).alias("cell_j")))
    rows = rows.withColumn("own", F.when(F.col("n_blocks").isNull(), 0).otherwise(own))
    rows = rows.withColumn("meet", F.explode(F.when(F.col("n_blocks").isNull(), one).otherwise(cells)))
    rows = rows.select(*[c for c in rows.columns if c not in ("meet", "n_blocks")], "meet.cell_i", "meet.cell_j")
    keys = [*bucket, "cell_i", "cell_j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys)


# ------------------------------------------------------------------ connected components

def connected_components(edges: DataFrame, cuts: Cuts) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: root is the smallest
    node reachable. Alternates the large-star and small-star steps of Kiveris
    et al. (2014), which end with one star per component after about log^2 n
    rounds. Each step is a grouped minimum (partial aggregation) and a join of
    two written tables, so AQE can split a hot centre."""
    e = cuts.save(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = cuts.save(e.select(F.col("a").alias("u"), F.col("b").alias("v"))
                         .unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v"))))
        low = cuts.save(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = (both.filter("v > u").join(low, "u").filter("v <> m")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        large = cuts.save(large)
        low = cuts.save(large.groupBy("a").agg(F.min("b").alias("m")))
        moved = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cuts.save(moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        sign = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == seen:
            break
        seen = sign
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


# ------------------------------------------------------------------ ranks without one sorting task

def global_rank(df: DataFrame, order: list, name: str, cuts: Cuts) -> DataFrame:
    """Add ``name``: the 0-based place of each row in the order ``order`` (which
    must be total). The range-partitioned rows are written once, so the place of
    a row does not depend on range bounds being drawn alike twice."""
    part = spare_name(df, "range_part")
    ranged = cuts.save(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    sizes = ranged.groupBy(part).count()
    before = sizes.select(part, (F.sum("count").over(Window.orderBy(part)) - F.col("count")).alias("rows_before"))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return (ranged.withColumn(name, place).join(F.broadcast(before), part)  # a row per range partition
            .withColumn(name, (F.col(name) + F.col("rows_before") - 1).cast("long")).drop(part, "rows_before"))
