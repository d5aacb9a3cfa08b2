"""Classifiers: nearest centroid (checkable against SQL), random forest and
multilayer perceptron (Spark ML), and scoring.

The nearest-centroid fit is one grouped aggregate (Spark ML ``Summarizer``,
partial on the map side); the model is the class-centre matrix, whose row
count and byte size are checked before it is read. Scoring runs as an Arrow
UDF: each batch's vectors are read from the Arrow list buffers as one matrix
(no per-row Python objects) and numpy computes the distances to the broadcast
centres, so there is no join between rows and centres and no
rows-times-centres intermediate.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.aggregates import require_rows
from featureflow.operators.arrow import rows_matrix
from featureflow.operators.columns import usable_vector, vector_dim, with_vector

DIST_DIGITS = 9
CENTERS_MAX_BYTES = 512 << 20


def centroid_means(df: DataFrame, features_col: str = "features", label_col: str = "label") -> DataFrame:
    """``label, center array<double>, n``: mean vector per label."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    rows = df.filter(F.col(features_col).isNotNull())
    vec = array_to_vector(F.col(features_col))
    return rows.groupBy(label_col).agg(
        Summarizer.mean(vec).alias("__m"), F.count(F.lit(1)).alias("n")
    ).select(label_col, vector_to_array(F.col("__m")).alias("center"), "n")


@dataclass
class CentroidModel:
    """Class centres, sorted by label. ``transform`` scores rows."""

    labels: list
    centers: np.ndarray
    label_type: str = "int"
    counts: list = field(default_factory=list)

    @property
    def dim(self) -> int:
        return int(self.centers.shape[1])

    def transform(
        self,
        df: DataFrame,
        features_col: str = "features",
        prediction_col: str = "prediction",
        probability_col: str | None = "probability",
        distance_col: str | None = None,
        digits: int = DIST_DIGITS,
    ) -> DataFrame:
        """Adds the nearest label (least squared distance rounded to
        ``digits``, ties to the lower label), softmax(-distance) over the
        labels in model order, and optionally the distance. Rows with a NULL
        vector or another dimension get NULLs, never a failed task."""
        out_type = f"struct<prediction:{self.label_type}{',probability:array<double>' if probability_col else ''}" \
                   f"{',distance:double' if distance_col else ''}>"
        scorer = _make_scorer(df.sparkSession, self.labels, self.centers, digits, out_type)
        tmp = "__nc"
        res = df.withColumn(tmp, scorer(F.col(features_col)))
        cols = [F.col(f"{tmp}.prediction").alias(prediction_col)]
        if probability_col:
            cols.append(F.col(f"{tmp}.probability").alias(probability_col))
        if distance_col:
            cols.append(F.col(f"{tmp}.distance").alias(distance_col))
        return res.select(*[c for c in df.columns], *cols)


def _make_scorer(spark: SparkSession, labels, centers: np.ndarray, digits: int, out_type: str):
    """Arrow UDF: the feature column arrives as an Arrow list array and the
    struct result is built as Arrow arrays; numpy does the distances."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    bc = spark.sparkContext.broadcast(np.ascontiguousarray(centers, dtype=np.float64))
    fields = _parse_datatype_string(out_type)
    wanted, label_type = fields.names, to_arrow_type(fields["prediction"].dataType)
    label_arr = pa.array(list(labels), type=label_type)

    @F.arrow_udf(out_type)
    def score(feats: pa.Array) -> pa.Array:
        c = bc.value
        k, d = c.shape
        valid, x = rows_matrix(feats, d)
        finite = np.isfinite(x).all(axis=1)
        valid = valid.copy()
        valid[np.flatnonzero(valid)[~finite]] = False
        x = x[finite]
        m = x.shape[0]
        dd = np.empty((m, k))
        for j in range(k):
            diff = x - c[j]
            dd[:, j] = np.einsum("ij,ij->i", diff, diff)
        best = np.argmin(np.round(dd, digits), axis=1)
        # rows without a usable vector take slot 0 and are masked to NULL
        slot = np.zeros(len(valid), dtype=np.int64)
        slot[valid] = best
        pred = label_arr.take(pa.array(slot)).to_numpy(zero_copy_only=False)
        parts = {"prediction": pa.array(pred, type=label_type, mask=~valid)}
        if "probability" in wanted:  # k numbers a row: only when asked for
            p = np.exp(-(dd - dd.min(axis=1, keepdims=True))) if m else dd
            p = p / p.sum(axis=1, keepdims=True) if m else p
            offsets = np.concatenate([[0], np.cumsum(np.where(valid, k, 0))]).astype(np.int32)
            parts["probability"] = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(p.ravel(), type=pa.float64()), mask=pa.array(~valid))
        if "distance" in wanted:
            dist = np.zeros(len(valid))
            dist[valid] = np.round(dd[np.arange(m), best], digits)
            parts["distance"] = pa.array(dist, mask=~valid)
        return pa.StructArray.from_arrays(list(parts.values()), names=list(parts))

    return score


def fit_centroids(
    train: DataFrame,
    features_col: str = "features",
    label_col: str = "label",
    max_bytes: int = CENTERS_MAX_BYTES,
) -> CentroidModel:
    """Nearest-centroid fit: per-label mean vector (one aggregate job over the
    training rows). The result, one row per class, stays on the executors
    until its shape is known. The centre matrix is read by the driver and
    broadcast for scoring, so one over ``max_bytes`` raises; vectors that are
    NULL, of another length than most or not finite are left out."""
    try:
        dim = vector_dim(train, features_col)
    except ValueError:
        raise ValueError("training input is empty") from None
    usable = train.filter(usable_vector(features_col, dim))
    means = centroid_means(usable, features_col, label_col).cache()
    try:
        k, d = means.agg(F.count(F.lit(1)), F.max(F.size("center"))).first()
        if k == 0:
            raise ValueError("training input is empty")
        if k * d * 8 > max_bytes:
            raise ValueError(f"centre matrix {k} x {d} exceeds {max_bytes} bytes")
        rows = means.collect()
    finally:
        means.unpersist()
    rows = sorted(rows, key=lambda r: (r[label_col] is None, r[label_col]))
    if rows[-1][label_col] is None:
        raise ValueError("NULL label in training input")
    centers = np.array([np.asarray(r["center"], dtype=np.float64) for r in rows])
    return CentroidModel(
        labels=[r[label_col] for r in rows],
        centers=centers,
        label_type=dict(train.dtypes)[label_col],
        counts=[int(r["n"]) for r in rows],
    )


def nearest_centroid(
    train: DataFrame, test: DataFrame, features_col: str = "features", label_col: str = "label",
    **kw,
) -> DataFrame:
    """Fit on ``train``, score ``test``."""
    return fit_centroids(train, features_col, label_col).transform(test, features_col, **kw)


# ---------------------------------------------------------------- Spark ML classifiers

def _dims(df: DataFrame, features_col: str, label_col: str) -> tuple[int, int]:
    """(most frequent vector size, number of classes = max label + 1 over usable rows)."""
    d = vector_dim(df, features_col)
    row = df.filter(usable_vector(features_col, d)).agg(F.max(label_col).alias("k"), F.min(label_col).alias("k0")).first()
    if row["k"] is None:
        raise ValueError("training input is empty")
    if row["k0"] < 0:
        raise ValueError("labels must be >= 0")
    return d, int(row["k"]) + 1


def train_forest(
    df: DataFrame, features_col: str = "features", label_col: str = "label",
    max_depth: int = 5, num_trees: int = 20, seed: int = 42, **params,
):
    """Random forest (defaults: depth 5, 20 trees). Raises on empty input; rows
    without a usable vector or label are left out."""
    from pyspark.ml.classification import RandomForestClassifier

    require_rows(df)
    usable = df.filter(usable_vector(features_col, vector_dim(df, features_col)) & F.col(label_col).isNotNull())
    data = with_vector(usable, features_col, "__fv").select("__fv", F.col(label_col).cast("double").alias("__y"))
    rf = RandomForestClassifier(featuresCol="__fv", labelCol="__y", maxDepth=max_depth,
                                numTrees=num_trees, seed=seed, **params)
    return rf.fit(data)


def train_mlp(
    df: DataFrame, features_col: str = "features", label_col: str = "label",
    hidden: tuple[int, ...] = (1024, 128, 64), max_iter: int = 100, block_size: int = 128,
    seed: int = 42, step_size: float = 0.03, solver: str = "l-bfgs",
):
    """Multilayer perceptron ``d -> hidden... -> classes`` (sigmoid hidden
    layers, softmax output). Input size and class count come from the data
    (rows without a usable vector or label are left out); raises on empty input."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    d, k = _dims(df, features_col, label_col)
    usable = df.filter(usable_vector(features_col, d) & F.col(label_col).isNotNull())
    data = with_vector(usable, features_col, "__fv").select("__fv", F.col(label_col).cast("double").alias("__y"))
    mlp = MultilayerPerceptronClassifier(
        featuresCol="__fv", labelCol="__y", layers=[d, *hidden, k], maxIter=max_iter,
        blockSize=block_size, seed=seed, stepSize=step_size, solver=solver,
    )
    return mlp.fit(data)


def forest_steps(model, df: DataFrame, features_col: str = "features", label_col: str = "label",
                 step_col: str = "step") -> DataFrame:
    """A row for every row of ``df`` and number of trees ``step`` = 1, 2, ...:
    ``prediction`` and ``probability`` of the forest of the first ``step`` trees.
    Each tree scores a row once; the running sum of its trees' class shares gives
    all steps, so no forest is fitted or scored again. Rows without a usable
    vector have NULLs. Rows multiply by the number of trees; a grouped aggregate
    over them combines before any shuffle."""
    from pyspark.ml.functions import vector_to_array

    ok = usable_vector(features_col, model.numFeatures)
    out, shares = with_vector(df, features_col, "__fv", model.numFeatures), []
    for i, tree in enumerate(model.trees):
        out = (tree.copy().setFeaturesCol("__fv").setPredictionCol("").setRawPredictionCol("").setProbabilityCol(f"__p{i}")
               .transform(out))
        shares.append(vector_to_array(F.col(f"__p{i}")))
    sums = F.aggregate(F.array(*shares), F.array().cast("array<array<double>>"), lambda done, p: F.concat(done, F.array(
        F.when(F.size(done) == 0, p).otherwise(F.zip_with(F.element_at(done, -1), p, lambda a, b: a + b)))))
    taken = {c.lower() for c in df.columns}
    if {step_col.lower(), "prediction", "probability"} & taken:
        raise ValueError(f"input has a column {step_col!r}, 'prediction' or 'probability' already")
    rows = out.select(*df.columns, ok.alias("__ok"), F.posexplode(sums).alias("__at", "__sum"))
    p = F.when(F.col("__ok"), F.transform("__sum", lambda x: x / (F.col("__at") + 1)))
    rows = rows.withColumn("probability", p)
    prediction = F.array_position("probability", F.array_max("probability")) - 1
    return rows.select(*df.columns, (F.col("__at") + 1).alias(step_col),
                       prediction.cast(dict(df.dtypes).get(label_col, "int")).alias("prediction"), "probability")


def predict(model, df: DataFrame, features_col: str = "features", label_col: str | None = "label",
            prediction_col: str = "prediction", probability_col: str = "probability") -> DataFrame:
    """Score with a fitted Spark ML classifier: adds ``prediction`` (as the
    label's type) and ``probability`` (array<double>), NULL for rows without a
    usable vector."""
    from pyspark.ml.functions import vector_to_array

    vec = with_vector(df, features_col, "__fv", model.numFeatures)
    ok = usable_vector(features_col, model.numFeatures)
    out = model.setFeaturesCol("__fv").setPredictionCol("__pred").transform(vec)
    ptype = dict(df.dtypes).get(label_col, "int") if label_col else "int"
    cols = [c for c in df.columns] + [F.when(ok, F.col("__pred")).cast(ptype).alias(prediction_col)]
    if "probability" in out.columns:
        cols.append(F.when(ok, vector_to_array(F.col("probability"))).alias(probability_col))
    return out.select(*cols)
