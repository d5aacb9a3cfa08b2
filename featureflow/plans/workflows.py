"""The stages of the original command line, as Spark jobs.

``pending_images``  manifest rows whose picture is not stored yet (the fetch
                    itself is a network client and is not part of this library)
``preprocess``      manifest x pictures -> crop -> resize -> Parquet of pictures
``features``        manifest x pictures -> crop + resize + features in one stage
``label``           pictures -> label records from the caller's labeller
``pixels``          manifest x pictures -> crop + resize + grey -> flat pixels
``train``           labels x features -> split -> samples (one write) -> model
                    -> metric history per split

Each stage reads its inputs with Spark sources, writes its output once with
Spark's commit protocol and returns a small status or metric table. Nothing
but those tables and the model reaches the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow import sinks
from featureflow.session import materialize, size_for_input
from featureflow.plans import ledger
from featureflow.operators import aggregates, classify, columns, evaluate, images, inference, joins, network, splits
from featureflow.sources.images import list_images, read_images
from featureflow.sources.labels import read_labels
from featureflow.sources.manifest import path_exists, read_manifest
from featureflow.sources.samples import read_samples

KEY = ["person", "image_id"]
FEATURES_SCHEMA = "person string, image_id bigint, features array<float>, status string"
PICTURES_SCHEMA = f"person string, image_id bigint, image {images.IMAGE_TYPE.simpleString()}, status string"


def manifest_rows(spark: SparkSession, manifest_paths: str | Sequence[str]) -> DataFrame:
    """Manifest with ``person`` (folder-safe name) and the parsed box."""
    m = read_manifest(spark, manifest_paths)
    m = columns.normalize_name(m, "name", "person")
    return columns.parse_bbox(m, "bbox", "bbox_coords")


def pending_images(spark: SparkSession, manifest_paths, image_root: str, ext: str = ".jpg") -> DataFrame:
    """Manifest rows with no stored picture yet, with the path to store it at."""
    todo = columns.with_image_path(manifest_rows(spark, manifest_paths), image_root, "person", "image_id",
                                   ext=ext)
    if not path_exists(spark, image_root):
        return todo
    done = list_images(spark, image_root, require_any=False).select(*KEY)
    return joins.pending(todo, done, KEY)


def _rows(spark, manifest_paths, out_path: str) -> DataFrame:
    """Manifest rows with their key, box and status."""
    paths = [manifest_paths] if isinstance(manifest_paths, str) else list(manifest_paths)
    size_for_input(spark, [p for p in [*paths, out_path] if path_exists(spark, p)])
    return manifest_rows(spark, manifest_paths).select(*KEY, "bbox_coords", "status")


def _stage(spark, manifest_paths, image_root: str, out_path: str, schema: str,
           work: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
    """Run ``work`` over the pictures of the rows still open in the table at
    ``out_path`` and return the status summary of the whole table. Rows that
    failed are tried again; those without a picture once it has come."""
    rows = _rows(spark, manifest_paths, out_path)
    listed = list_images(spark, image_root, require_any=False).select(*KEY)
    done = ledger.run_stage(
        spark, out_path, rows, KEY, schema, lambda todo: work(_manifest_pictures(spark, todo, image_root)),
        partition_by, available=listed)
    return aggregates.status_summary(done)


def _manifest_pictures(spark, rows: DataFrame, image_root) -> DataFrame:
    """Manifest rows joined to their decoded picture; no picture -> status
    ``missing_image``.

    One plan at all sizes: the pictures, the big side, are inner-joined to the
    manifest, and rows without a picture come from an anti join with the file
    listing, which carries keys only. The planner broadcasts a manifest under
    ``spark.sql.autoBroadcastJoinThreshold`` and no picture moves; a larger
    manifest means a shuffle of the decoded pictures (Spark's image source
    decodes as it reads), so raise that threshold as far as executors allow.
    """
    pics = read_images(spark, image_root).select(*KEY, "image", F.col("status").alias("__pic_status"))
    hit = pics.join(rows, KEY, "inner").select(*KEY, "bbox_coords", "status", "image", "__pic_status")
    listed = list_images(spark, image_root, require_any=False).select(*KEY)
    miss = joins.pending(rows, listed, KEY).select(
        *KEY, "bbox_coords", "status", F.lit(None).cast(images.IMAGE_TYPE).alias("image"),
        F.lit(None).cast("string").alias("__pic_status"))
    j = hit.unionByName(miss)
    j = columns.with_status(j, F.col("__pic_status").isNull(), "missing_image")
    j = columns.with_status(j, F.col("__pic_status") != "ok", "undecodable")
    return j.drop("__pic_status")


def preprocess(
    spark: SparkSession, manifest_paths, image_root: str, out_path: str,
    size: int = 128, box: str = "xyxy", method: str = "bilinear",
) -> DataFrame:
    """Crop + resize every manifest picture that ``out_path`` doesn't hold as ok
    yet (one fused stage) and add ``image_id, image, status, attempt`` as Parquet,
    a folder per person and attempt. Returns the status summary of each row's
    latest attempt. A run with nothing new to do reads no picture."""
    def work(j: DataFrame) -> DataFrame:
        return images.crop_resize(j, "bbox_coords", box, size, method).select(*KEY, "image", "status")

    return _stage(spark, manifest_paths, image_root, out_path, PICTURES_SCHEMA, work, ["person"])


def features(
    spark: SparkSession, manifest_paths, image_root: str, out_path: str,
    size: int = 128, box: str = "xyxy", method: str = "bilinear",
    extractor: Callable[[np.ndarray], np.ndarray] | None = None,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]] | None = None,
) -> DataFrame:
    """Feature vector per manifest picture that ``out_path`` doesn't hold as ok
    yet (crop, resize, extract or the caller's batch model, fused in one stage);
    adds ``person, image_id, features, status, attempt``; returns the status
    summary of each row's latest attempt."""
    def work(j: DataFrame) -> DataFrame:
        return inference.image_features(j, "bbox_coords", box, size, method, extractor=extractor,
                                        make_predict_fn=make_predict_fn).select(*KEY, "features", "status")

    return _stage(spark, manifest_paths, image_root, out_path, FEATURES_SCHEMA, work)


def label(
    spark: SparkSession, image_root: str, out_path: str,
    make_label_fn: Callable[[], Callable[[list[np.ndarray]], Sequence[str]]],
) -> DataFrame:
    """Pictures -> label records ``image_path, emotion, error`` as JSON lines;
    returns the number of labelled and failed pictures as a status summary."""
    pics = read_images(spark, image_root).select(F.col("path").alias("image_path"), "image")
    sinks.write_table(inference.label_images(pics, make_label_fn), out_path, "json")
    done = read_labels(spark, out_path, multiline=False)
    return aggregates.status_summary(done.select(F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status")))


def pixels(
    spark: SparkSession, manifest_paths, image_root: str, out_path: str,
    size: int = 224, box: str = "xywh", channels: int = 3, method: str = "bilinear",
) -> DataFrame:
    """Manifest pictures -> crop -> ``size`` -> grey in ``channels`` equal
    channels -> flat pixels as ``features``; what ``train`` reads for a
    classifier on pixels. Returns the status summary of the whole table."""
    def work(j: DataFrame) -> DataFrame:
        return inference.image_features(j, "bbox_coords", box, size, method, gray_channels=channels,
                                        extractor=lambda a: a.ravel()).select(*KEY, "features", "status")

    return _stage(spark, manifest_paths, image_root, out_path, FEATURES_SCHEMA, work)


SAMPLE_SCHEMA = "person string, image_id bigint, label int, features array<float>, split string"


def build_samples(
    spark: SparkSession, labels_path: str, features_path: str, out_path: str,
    mapping: Mapping[str, int] | None = None, weights: Mapping[str, float] | None = None, seed: int = 0,
    max_records: int | None = None, features_format: str = "parquet", labels_multiline: bool = True,
) -> DataFrame:
    """Labels x features -> split -> one Parquet write (folders per split).
    Returns the written samples (read back with a fixed schema).

    ``features_path`` is the table written by ``features`` (``parquet``) or a
    folder of ``<person>/<id>.npy`` vector files (``npy``). ``labels_multiline``
    False reads JSON lines, which Spark splits by block; the array form is one
    task a file."""
    size_for_input(spark, [labels_path, features_path])
    labs = columns.valid_labels(read_labels(spark, labels_path, labels_multiline))
    labs = columns.with_path_parts(labs, "image_path")
    labs = labs.select(F.col("parent").alias("person"), F.col("stem").try_cast("bigint").alias("image_id"),
                       "emotion")
    labs = columns.encode_label(labs, "emotion", mapping)
    if features_format == "parquet":
        feats = spark.read.parquet(features_path)
    elif features_format == "npy":
        from featureflow.sources.vectors import read_vector_files

        feats = read_vector_files(spark, features_path)
    else:
        raise ValueError(f"features_format must be 'parquet' or 'npy', not {features_format!r}")
    feats = feats.filter(F.col("status") == "ok").select(*KEY, "features")
    samples = joins.join_features(labs, feats, KEY).select(*KEY, "label", "features")
    samples = splits.hash_split(samples, KEY, dict(weights) if weights else None, seed)
    sinks.write_samples(samples, out_path, max_records=max_records)
    return read_samples(spark, out_path, schema=SAMPLE_SCHEMA)


def train(
    spark: SparkSession, labels_path: str, features_path: str, out_dir: str,
    model: str = "forest", mapping: Mapping[str, int] | None = None,
    weights: Mapping[str, float] | None = None, run_id: str = "run", features_format: str = "parquet",
    labels_multiline: bool = True, **params,
) -> DataFrame:
    """Build samples, fit on ``train``, score every split and append the metric
    history (``run_id, step, split, metric, value``). Raises on an empty
    training set. ``model``: ``forest``, ``mlp``, ``network`` or ``centroid``.
    A forest's step is a number of trees, a network's an epoch; the others have
    step 0 alone. A network keeps its epochs under ``out_dir/epochs``."""
    out_dir = out_dir.rstrip("/")
    s = build_samples(spark, labels_path, features_path, f"{out_dir}/samples", mapping, weights,
                      features_format=features_format, labels_multiline=labels_multiline)
    tr = s.filter(F.col("split") == "train")
    aggregates.require_rows(tr, "training split")
    if model == "forest":
        fitted = classify.train_forest(tr, **params)
        pred = classify.forest_steps(fitted, s)
    elif model == "network":
        # the epochs of this training set; another one's aren't gone on with
        epochs = f"{out_dir}/epochs/{uuid.uuid4().hex}"
        fitted = network.train_network(tr, folder=epochs, key=KEY, **params)
        pred = network_steps(fitted, s)
    elif model == "mlp":
        fitted = classify.train_mlp(tr, **params)
        pred = classify.predict(fitted, s)
    elif model == "centroid":
        fitted = classify.fit_centroids(tr)
        pred = fitted.transform(s)
    else:
        raise ValueError(f"unknown model {model!r}")
    classes = fitted.labels if model == "centroid" else None
    hist = evaluate.evaluate_splits(pred, run_id=run_id, step=0, classes=classes,
                                    step_col="step" if model in ("forest", "network") else None)
    if model != "network":  # its epochs are the stored model
        sinks.save_model(fitted, f"{out_dir}/model")
    sinks.append_metrics(hist, f"{out_dir}/metrics")
    return sinks.read_metrics(spark, f"{out_dir}/metrics").filter(F.col("run_id") == run_id)


def network_steps(fitted: network.Network, df: DataFrame, features_col: str = "features") -> DataFrame:
    """``df`` scored by the network after every epoch, as ``step`` 1, 2, ..."""
    spark = df.sparkSession
    return reduce(DataFrame.unionByName, [
        fitted.at(spark, epoch).transform(df, features_col).withColumn("step", F.lit(epoch))
        for epoch in range(1, len(fitted.losses) + 1)])


def cluster_vectors(
    spark: SparkSession, features_dir: str, out_path: str, k: int = 5, seed: int = 42, fmt: str = "csv",
) -> DataFrame:
    """Vector files -> k-means -> ``filename, cluster`` table (CSV with header by
    default). Files that do not parse are left out of the fit and reported in
    the returned status summary."""
    from featureflow.operators.cluster import kmeans
    from featureflow.sources.vectors import read_vector_files

    # the files are parsed once: the fit, the scoring and the summary read the checkpoint
    vecs = materialize(read_vector_files(spark, features_dir))
    ok = vecs.filter(F.col("status") == "ok")
    clustered, _ = kmeans(ok, k, seed, "features")
    sinks.write_table(clustered, out_path, fmt, columns=["person", "filename", "cluster"])
    return aggregates.status_summary(vecs)


def project_vectors(spark: SparkSession, features_dir: str, out_path: str) -> DataFrame:
    """Vector files -> one global 2-D projection -> ``person, filename, x, y``
    (Parquet); names travel with their row, so no positional re-join is needed."""
    from featureflow.operators.project import project_2d
    from featureflow.sources.vectors import read_vector_files

    vecs = materialize(read_vector_files(spark, features_dir).filter(F.col("status") == "ok"))
    pts = project_2d(vecs, "features").select("person", "filename", "x", "y")
    sinks.write_table(pts, out_path)
    return spark.read.parquet(out_path)
