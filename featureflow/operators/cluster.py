"""Clustering: Spark ML k-means, plus an explicit assignment step and one
Lloyd update so that a clustering can be checked against SQL.

Centres are a k x d matrix bounded by ``k``; assignment scores rows in an
Arrow-batched pandas UDF against the broadcast matrix (no join, no
rows-times-centres table).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.operators.classify import CentroidModel, centroid_means
from featureflow.operators.columns import usable_vector, vector_dim, with_vector


def kmeans(
    df: DataFrame, k: int = 5, seed: int = 42, features_col: str = "features",
    prediction_col: str = "cluster", max_iter: int = 20, tol: float = 1e-4,
):
    """Spark ML k-means (k-means|| start). Returns ``(df + cluster, model)``.
    The array column is converted to a vector in the JVM; the estimator caches
    its own input while it iterates. Rows without a usable vector (NULL, another
    length than most, not finite) are left out of the fit and get NULL."""
    from pyspark.ml.clustering import KMeans

    dim = vector_dim(df, features_col)
    vec = with_vector(df, features_col, "__fv", dim)
    ok = usable_vector(features_col, dim)
    model = KMeans(k=k, seed=seed, featuresCol="__fv", predictionCol=prediction_col,
                   maxIter=max_iter, tol=tol).fit(vec.filter(ok))
    out = model.transform(vec).drop("__fv")
    return out.withColumn(prediction_col, F.when(ok, F.col(prediction_col))), model


def init_centroids(df: DataFrame, k: int, order_by: str | list[str], features_col: str = "features") -> CentroidModel:
    """Start centres = the first ``k`` rows in ``order_by`` order (a top-k, so
    only ``k`` rows reach the driver); cluster ids 0..k-1 in that order."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rows = df.select(*order, features_col).orderBy(*order).limit(k).collect()
    if len(rows) < k:
        raise ValueError(f"only {len(rows)} rows for k={k}")
    centers = np.array([np.asarray(r[features_col], dtype=np.float64) for r in rows])
    return CentroidModel(labels=list(range(k)), centers=centers, label_type="int")


def assign_centroids(
    df: DataFrame, centroids: CentroidModel, features_col: str = "features", out: str = "cluster",
    distance_col: str | None = "distance",
) -> DataFrame:
    """Nearest centre per row (squared distance rounded to 9 digits, ties to
    the lower id)."""
    return centroids.transform(df, features_col, prediction_col=out, probability_col=None,
                               distance_col=distance_col)


def lloyd_step(assigned: DataFrame, features_col: str = "features", cluster_col: str = "cluster") -> DataFrame:
    """New centres from an assignment: ``cluster, center, n`` (mean per cluster,
    partial aggregation on the map side, so a huge cluster is not one task)."""
    return centroid_means(assigned.filter(F.col(cluster_col).isNotNull()), features_col, cluster_col)


#: A round of ``parallel_start`` takes at most this many times the rows it expects.
DRAWS_MAX = 8


def draw(key: str, step: int, seed: int) -> Column:
    """Uniform in [0, 1) by key, step and seed: the same on any partitioning."""
    text = F.concat(F.col(key).cast("string"), F.lit(f":{step}:{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def parallel_start(df: DataFrame, k: int, key: str, features_col: str = "features", steps: int = 2,
                   oversample: int | None = None, seed: int = 42, digits: int = 9) -> CentroidModel:
    """Start centres by k-means|| (Bahmani et al., 2012), the same on any
    partitioning. The row with the smallest draw comes first. In each of ``steps``
    rounds every row joins with the chance ``oversample`` (2k) x its share of all
    squared distances to the nearest centre so far; the distances are added up
    as decimals, in any order. Of the centres, weighed by the rows nearest to each,
    ``k`` are picked: the heaviest, then again and again the one with the
    greatest weight x squared distance to those picked (ties: the one drawn first).

    Equal vectors are one candidate. About ``oversample`` rows a round reach the driver,
    ``DRAWS_MAX`` times as many at most (with a repeated ``key`` draws go
    together). Fewer different vectors than ``k`` raise.
    """
    dim = vector_dim(df, features_col)
    rows = df.filter(usable_vector(features_col, dim) & F.col(key).isNotNull())
    rows = rows.select(F.col(key).alias("key"), F.col(features_col).alias("features"))
    want = oversample or 2 * k

    def take(found: DataFrame, n: int) -> np.ndarray:
        """The rows with the smallest draws, a row per vector."""
        once = found.groupBy("features").agg(F.min(F.struct("u", "key")).alias("first"))
        best = once.orderBy("first.u", "first.key", "features").limit(n).collect()
        return np.array([r["features"] for r in best], dtype=np.float64).reshape(-1, dim)

    first = rows.select("features", "key", draw("key", 0, seed).alias("u"))
    centers = take(first.orderBy("u", "key", "features").limit(1), 1)
    for step in range(1, steps + 1):
        near = assign_centroids(rows, _numbered(centers), "features", "__c", "__d")
        total = near.agg(F.sum(F.col("__d").cast(f"decimal(38,{digits})")).cast("double")).first()[0]
        u = draw("key", step, seed)
        drawn = near.select("features", "key", "__d", u.alias("u")).filter(F.col("u") * total < want * F.col("__d"))
        centers = np.concatenate([centers, take(drawn, DRAWS_MAX * want)])
    if len(centers) < k:
        centers = np.concatenate([centers, take(assign_centroids(first, _numbered(centers), "features", "__c", "__d").filter("__d > 0"), k)])
    if len(centers) < k:
        raise ValueError(f"only {len(centers)} different vectors for k={k}")
    counts = assign_centroids(rows, _numbered(centers), "features", "__c", None).groupBy("__c").agg(F.count(F.lit(1)).alias("n"))
    weight = np.zeros(len(centers))
    for r in counts.collect():  # a row per candidate
        weight[r["__c"]] = r["n"]
    gain, near, picked = weight.copy(), np.full(len(centers), np.inf), []
    for _ in range(k):
        at = int(np.argmax(gain))
        picked.append(at)
        near = np.minimum(near, np.round(((centers - centers[at]) ** 2).sum(axis=1), digits))
        gain = weight * near
    return _numbered(centers[picked])


def _numbered(centers: np.ndarray) -> CentroidModel:
    return CentroidModel(labels=list(range(len(centers))), centers=centers, label_type="int")


def lloyd(df: DataFrame, k: int = 5, order_by: str | list[str] = "vec_id", rounds: int = 5,
          features_col: str = "features", out: str = "cluster", distance_col: str | None = "distance",
          digits: int = 9, start: CentroidModel | None = None) -> DataFrame:
    """K-means that any engine reproduces: ``start`` or the first ``k`` usable rows in
    ``order_by`` order, then ``rounds`` Lloyd steps with centres rounded to
    ``digits``; a cluster that loses all rows keeps its centre. Only k centres
    reach the driver in a round."""
    dim = vector_dim(df, features_col)
    model = start or init_centroids(df.filter(usable_vector(features_col, dim)), k, order_by, features_col)
    for _ in range(rounds):
        step = lloyd_step(assign_centroids(df, model, features_col, "__c", None), features_col, "__c").collect()
        centers = model.centers.copy()
        for r in step:
            centers[r["__c"]] = np.round(np.asarray(r["center"]), digits)
        model = CentroidModel(labels=model.labels, centers=centers, label_type="int")
    return assign_centroids(df, model, features_col, out, distance_col)
