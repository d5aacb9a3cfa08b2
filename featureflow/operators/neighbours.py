"""Nearest neighbours of feature vectors, as joins.

``neighbour_graph`` finds the k nearest vectors of each vector by neighbour
descent (Dong et al., 2011): the members of small groups are compared with each
other and each keeps its k best. First groups are stretches of the order along
fixed random directions; then each vector's group is itself, its neighbours and
some of those it is a neighbour of. Draws are hashes of ids, so the same rows
give the same graph on any partitioning.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.operators.columns import usable_vector, vector_dim
from featureflow.operators.splits import with_batch_id
from featureflow.session import checkpoint_dir

NEIGHBOURS, DIRECTIONS, DESCENTS = 15, 4, 4
GROUP_ROWS = 8192  # rows a call compares, in groups


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder. Read back it has its real
    size: a checkpoint keeps the estimate of its plan, which joins multiply round by round."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/graph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nearest(ids: np.ndarray, x: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, other id, distance): the k nearest others of each row within its
    group, over all groups each pair once and the k best of an id. Squares are
    summed row by row, so a distance is the same in any group."""
    a, b, dist = [], [], []
    for s, e in zip(starts, [*starts[1:], len(ids)], strict=True):
        own, rows = ids[s:e], x[s:e]
        for p in range(e - s):
            d2 = ((rows - rows[p]) ** 2).sum(axis=1)
            d2[p] = np.inf
            best = np.lexsort((own, d2))[:k]
            best = best[np.isfinite(d2[best])]
            a.append(np.full(len(best), own[p]))
            b.append(own[best])
            dist.append(np.sqrt(d2[best]))
    a, b, dist = np.concatenate(a), np.concatenate(b), np.concatenate(dist)
    turn = np.lexsort((b, dist, a))
    a, b, dist = a[turn], b[turn], dist[turn]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, dist = a[new], b[new], dist[new]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, np.int64)
    place = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
    return a[place < k], b[place < k], dist[place < k]


def compare_groups(members: DataFrame, vectors: DataFrame, k: int, calls: int) -> DataFrame:
    """``i, j, dist``: the best pairs found in groups ``members(g, i)``. Groups are
    small; some thousand rows of them are a call."""
    def call(table: pa.Table) -> pa.Table:
        table = table.sort_by([("g", "ascending"), ("i", "ascending")])
        g, ids = table.column("g").to_numpy(), table.column("i").to_numpy()
        x = np.stack(table.column("v").to_numpy()).astype(np.float64)
        a, b, dist = nearest(ids, x, np.flatnonzero(np.append(True, g[1:] != g[:-1])), k)
        return pa.table({"i": pa.array(a, pa.int64()), "j": pa.array(b, pa.int64()), "dist": pa.array(dist, pa.float64())})

    rows = members.distinct().join(vectors, "i").select("g", "i", "v")
    return rows.groupBy(F.pmod(F.xxhash64("g"), F.lit(calls))).applyInArrow(call, "i long, j long, dist double")


def best_of(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each id. Pairs come in as the k best a call, so an id that
    is in very many groups is k entries a call; they merge by partial aggregation."""
    each = pairs.groupBy("i", "j").agg(F.min("dist").alias("dist"))
    top = each.groupBy("i").agg(F.slice(F.array_sort(F.collect_list(F.struct("dist", "j"))), 1, k).alias("top"))
    return top.select("i", F.explode("top").alias("t")).select("i", "t.j", "t.dist")


def neighbour_graph(df: DataFrame, id_col: str = "sample_id", features_col: str = "features", k: int = NEIGHBOURS,
                    directions: int = DIRECTIONS, descents: int = DESCENTS) -> DataFrame:
    """``i, j, dist``: for each usable vector the k nearest others found (all, if
    there are fewer), by Euclidean distance, ties to the smaller id. Approximate:
    more ``directions`` and ``descents`` find more; on the way each vector holds
    twice as many neighbours, which finds more than more rounds. Ids must be unique whole
    numbers; rows with a null id or an unusable vector take no part."""
    d = vector_dim(df, features_col)
    vectors = written(df.filter(F.col(id_col).isNotNull() & usable_vector(features_col, d)).select(
        F.col(id_col).cast("long").alias("i"), F.col(features_col).alias("v")))
    n = vectors.count()
    if vectors.select("i").distinct().count() < n:
        raise ValueError("ids repeat")
    wanted, k = k, 2 * k
    calls = max(1, -(-n * (2 * k + 1) // GROUP_ROWS))
    draws = np.random.default_rng(7).normal(size=(directions, d))
    graph = None
    for r in draws:
        weights = F.array(*[F.lit(float(w)) for w in r])
        value = F.aggregate(F.zip_with("v", weights, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        order = with_batch_id(vectors.select("i", value.alias("value")), ["value", "i"], 2 * k + 1, out="g")
        found = compare_groups(order.select("g", "i"), vectors, k, calls)
        graph = written(best_of(found if graph is None else found.unionByName(graph), k))
    for turn in range(descents):
        # of those that have an id as neighbour about k, drawn by a hash
        degree = graph.groupBy("j").agg(F.count(F.lit(1)).alias("degree"))
        draw = F.pmod(F.xxhash64("i", "j", F.lit(turn)), F.lit(1 << 30)) * F.col("degree") < F.lit(k << 30)
        back = graph.join(degree, "j").filter(draw).select(F.col("j").alias("g"), "i")
        members = (graph.select(F.col("i").alias("g"), F.col("j").alias("i")).unionByName(back)
                   .unionByName(vectors.select(F.col("i").alias("g"), "i")))
        graph = written(best_of(compare_groups(members, vectors, k, calls).unionByName(graph), k))
    return best_of(graph, wanted)
