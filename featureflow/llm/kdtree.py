"""Exact top-k inner-product search with a KD-tree per shard.

The vectors are dealt to shards by a hash; each shard's tree splits its widest
dimension at the median down to small leaves, and each node keeps the tight
bounding box of its vectors. The largest inner product a box allows, the sum of
max(q_i lo_i, q_i hi_i), bounds every score below it. A query visits nodes best
bound first and stops when no bound reaches its k-th best score.

The k-th score travels: queries first search one shard each, then all others
from that score on, so fewer of their nodes are opened. A shard's rows come
first in its task, then the queries stream through in blocks: a task holds one
tree and one block, whatever the input's size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import Cuts, group_starts
from featureflow.llm.vectors import is_finite_vector, matrix

SHARD_ROWS = 4096
QUERY_ROWS = 512
LEAF = 64
EXACT = 2.0 ** 53
LONG = 2 ** 63 - 1


class Tree:
    """Median splits with tight boxes over the rows of ``x`` (whole numbers)."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.low, self.high, self.child, self.span = [], [], [], []
        order = np.arange(len(x))
        todo = [(0, len(x), -1)]
        while todo:
            a, b, parent = todo.pop()
            rows = x[order[a:b]]
            node, low, high = len(self.low), rows.min(axis=0), rows.max(axis=0)
            self.low.append(low), self.high.append(high), self.span.append((a, b)), self.child.append([])
            if parent >= 0:
                self.child[parent].append(node)
            wide = int(np.argmax(high - low))
            if b - a > leaf and high[wide] > low[wide]:
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(rows[:, wide], mid)]
                todo += [(a, a + mid, node), (a + mid, b, node)]
        self.x, self.ids = x[order], ids[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bound of each query's score in each node (queries x nodes)."""
        return np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T

    def search(self, q: np.ndarray, own: int, bound: np.ndarray, k: int, kth: float) -> list[tuple[float, int]]:
        """The ``k`` best (score, id) with score >= ``kth``, ties to the smaller
        id, without the query's own id. ``bound``: its row of ``bounds``."""
        best: list[tuple[float, int]] = []  # smallest first: (score, -id)
        todo = [(-bound[0], 0)]
        while todo:
            top, node = heapq.heappop(todo)
            if -top < kth:
                break
            if self.child[node]:
                for c in self.child[node]:
                    if bound[c] >= kth:
                        heapq.heappush(todo, (-bound[c], c))
                continue
            a, b = self.span[node]
            score = self.x[a:b] @ q
            if score.dtype == object:
                score = np.array([max(-LONG - 1, min(LONG, s)) for s in score], dtype=object)
            for i in np.flatnonzero(score >= kth):
                found = (score[i], -int(self.ids[a + i]))
                if -found[1] == own or score[i] < kth:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
                if len(best) == k:
                    kth = max(kth, best[0][0])
        return [(s, -i) for s, i in best]


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(y) for y in r] for r in x], dtype=object).reshape(x.shape)


class Shard:
    """A shard's tree, built when its first query comes."""

    def __init__(self, scale: float):
        self.scale, self.ids, self.rows, self.tree = scale, [], [], None

    def add(self, ids: np.ndarray, v: np.ndarray) -> None:
        self.ids.append(ids), self.rows.append(np.floor(self.scale * v))

    def search(self, ids: np.ndarray, v: np.ndarray, kth: list[int | None], k: int) -> list[tuple[int, int, int]]:
        if not self.rows:
            return []
        if self.tree is None:
            self.tree = Tree(np.concatenate(self.rows), np.concatenate(self.ids))
        tree, q, out = self.tree, np.floor(self.scale * v), []
        if float(np.abs(tree.x).max()) * float(np.abs(q).max()) * q.shape[1] >= EXACT:
            # sums that doubles can't hold: the same search in Python's integers
            tree, q = Tree(_integers(tree.x), tree.ids), _integers(q)
        for at in range(0, len(q), QUERY_ROWS):
            bounds = tree.bounds(q[at:at + QUERY_ROWS])
            for i, bound in enumerate(bounds, at):
                start = -np.inf if kth[i] is None else kth[i]
                out += [(int(ids[i]), id_, int(score)) for score, id_ in tree.search(q[i], int(ids[i]), bound, k, start)]
        return out


def search_shards(rows: DataFrame, k: int, scale: float) -> DataFrame:
    """``query_id, vec_id, score`` from rows ``shard, asked, id, v, kth``, which
    come sorted by shard and hold its vectors before its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, Shard(scale)
        for b in batches:
            if not b.num_rows:
                continue
            number, asked = b.column("shard").to_numpy(), b.column("asked").to_numpy()
            starts = group_starts([number, asked])
            out: list[tuple[int, int, int]] = []
            for s, e in zip(starts, [*starts[1:], b.num_rows], strict=True):
                if number[s] != at:
                    at, shard = number[s], Shard(scale)
                part = b.slice(s, e - s)
                ids, v = part.column("id").to_numpy(), matrix(part.column("v"))
                if asked[s]:
                    out += shard.search(ids, v, part.column("kth").to_pylist(), k)
                else:
                    shard.add(ids, v)
            if out:
                query, found, score = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(found, pa.int64()),
                     pa.array(score, pa.int64())], names=["query_id", "vec_id", "score"])

    return rows.repartition("shard").sortWithinPartitions("shard", "asked", "id").mapInArrow(
        run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, cuts: Cuts, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = 5, scale: float = 256.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k``
    rows of ``vectors`` with the largest inner product of floor(scale * x),
    ties to the smaller id, without the row of its own id; all if fewer.

    Rows with a null id, or a vector that is null, empty or has null or
    non-finite components, take no part. A repeated id counts once, with its
    smallest vector. Vectors are compared with queries of their length only.
    Scores beyond a long count as its limit. Other columns don't matter. Queries
    without any candidate and empty tables give no rows.
    """
    def clean(df: DataFrame) -> DataFrame:
        d = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        d = d.filter(F.col("id").isNotNull() & is_finite_vector("v")).groupBy("id").agg(F.min("v").alias("v"))
        return d.withColumn("d", F.size("v"))

    rows, asked = cuts.save(clean(vectors)), cuts.save(clean(queries))
    sizes = {r.d: r.n for r in rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}  # by vector length
    parts = []
    for d, n in sorted(sizes.items()):
        shards = -(-n // shard_rows)
        x = rows.filter(F.col("d") == d).select(
            F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("asked"), "id", "v",
            F.lit(None).cast("long").alias("kth"))
        q = asked.filter(F.col("d") == d).withColumn("home", F.pmod(F.xxhash64("id", F.lit("q")), F.lit(shards)).cast("int"))
        first = cuts.save(search_shards(x.unionByName(q.select(
            F.col("home").alias("shard"), F.lit(1).alias("asked"), "id", "v", F.lit(None).cast("long").alias("kth"))),
            k, scale))
        parts.append(first)
        if shards > 1:
            kth = cuts.save(first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
                            .filter(F.col("n") >= k).select("query_id", "kth"))
            q = q.join(kth, q.id == kth.query_id, "left")
            others = F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), F.col("home"))
            parts.append(cuts.save(search_shards(x.unionByName(q.select(
                F.explode(others).alias("shard"), F.lit(1).alias("asked"), "id", "v", "kth")), k, scale)))
    schema = "query_id long, vec_id long, score long"
    found = vectors.sparkSession.createDataFrame([], schema)
    for p in parts:
        found = found.unionByName(p)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
