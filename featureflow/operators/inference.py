"""Models over pictures: feature extraction and labelling, in batches on the
executors.

The model is the caller's: a ``make_predict_fn`` (no arguments, returns a
function from a batch array to a batch of outputs) is called once per Python
worker and cached there, as ``predict_batch_udf`` does, so weights load once
per worker and never per row. A built-in extractor (block means + intensity
histogram, numpy only) stands in when no model is given.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.operators import images as img


def block_features(arr: np.ndarray, grid: int = 4, bins: int = 0) -> np.ndarray:
    """Built-in extractor: grid x grid block means (+ a ``bins``-bin histogram)."""
    parts = [img.block_means(arr, grid)]
    if bins:
        parts.append(img.intensity_histogram(arr, bins))
    return np.concatenate(parts)


def block_mean(df: DataFrame, grid: int = 4, bins: int = 0, image_col: str = "image", out: str = "features",
               status_col: str = "status", dtype: str = "float") -> DataFrame:
    """Feature vector per picture from the built-in extractor."""
    el = T.FloatType() if dtype == "float" else T.DoubleType()
    return img.map_image_values(df, lambda a, _: block_features(a, grid, bins), out, T.ArrayType(el),
                                image_col, status_col=status_col)


def block_mean_predict_fn(grid: int = 4, bins: int = 0) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """The built-in extractor in ``make_predict_fn`` form, for ``extract_features``."""
    def make():
        def predict(batch: np.ndarray) -> np.ndarray:
            return np.stack([block_features(x, grid, bins) for x in batch]).astype(np.float32)
        return predict
    return make


def extract_features(
    df: DataFrame,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    input_col: str = "pixels",
    shape: Sequence[int] = (128, 128, 3),
    out: str = "features",
    batch_size: int = 64,
) -> DataFrame:
    """Feature vector per row from the caller's batch model (``predict_batch_udf``):
    ``input_col`` holds flat pixels of one fixed ``shape``; the model sees
    batches of ``batch_size`` arrays shaped ``(batch, *shape)`` and returns
    ``(batch, d)``. NULL input rows give NULL features."""
    from pyspark.ml.functions import predict_batch_udf

    udf = predict_batch_udf(
        make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size,
        input_tensor_shapes=[list(shape)],
    )
    ok = F.col(input_col).isNotNull() & (F.size(input_col) == int(np.prod(shape)))
    return df.withColumn(out, F.when(ok, udf(F.col(input_col))))


def image_features(
    df: DataFrame,
    box_col: str | None = "bbox_coords",
    box: str = "xyxy",
    size: int | tuple[int, int] = 128,
    method: str = "bilinear",
    gray_channels: int | None = None,
    extractor: Callable[[np.ndarray], np.ndarray] | None = None,
    image_col: str = "image",
    out: str = "features",
    status_col: str = "status",
    dtype: str = "float",
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]] | None = None,
    batch_size: int = 64,
) -> DataFrame:
    """Crop + resize (+ grey) + features fused into one ``mapInPandas`` stage:
    the intermediate crops are never written or shuffled.

    ``make_predict_fn`` gives the caller's batch model: built once per Python
    worker, it sees ``(n, height, width, channels)`` arrays of up to
    ``batch_size`` pictures and returns ``n`` vectors. A batch that raises is
    retried picture by picture. Else ``extractor`` (one picture at a time) or the
    built-in block features."""
    hw = (size, size) if isinstance(size, int) else tuple(size)
    resizer = img.RESIZERS[method]
    cropper = img.CROPPERS[box]
    feat = extractor or (lambda a: block_features(a, 4, 16))

    def prepare(arr, row):
        if box_col is not None:
            arr = cropper(arr, img.box_of(row, box_col))
        arr = resizer(arr, hw)
        return img.gray(arr, gray_channels) if gray_channels else arr

    el = T.FloatType() if dtype == "float" else T.DoubleType()
    args = [box_col] if box_col else []
    if make_predict_fn is None:
        return img.map_image_values(df, lambda arr, row: feat(prepare(arr, row)), out, T.ArrayType(el), image_col,
                                    args=args, status_col=status_col)
    key = uuid.uuid4().hex

    def batch(arrays: list[np.ndarray]) -> list:
        from featureflow.operators.worker_cache import once

        model = once(key, make_predict_fn)
        found: list = []
        for at in range(0, len(arrays), batch_size):
            part = [a if a.ndim == 3 else a[:, :, None] for a in arrays[at:at + batch_size]]
            found += _model_rows(model, part)
        return found

    return img.map_image_values(df, prepare, out, T.ArrayType(el), image_col, args=args, status_col=status_col,
                                batch_fn=batch)


def _model_rows(model, arrays: list[np.ndarray]) -> list:
    """The model's output for each array, or the exception it raised for it.
    Arrays of one shape are stacked and go to the model together."""
    out: list = [None] * len(arrays)
    shapes: dict[tuple, list[int]] = {}
    for i, a in enumerate(arrays):
        shapes.setdefault(a.shape, []).append(i)
    for rows in shapes.values():
        try:
            got = list(model(np.stack([arrays[i] for i in rows])))
            if len(got) != len(rows):
                raise ValueError(f"model returned {len(got)} rows for {len(rows)} pictures")
        except Exception as e:  # noqa: BLE001 - one by one, so that only bad pictures fail
            if len(rows) == 1:
                got = [e]
            else:
                got = [x for i in rows for x in _model_rows(model, [arrays[i]])]
        for i, g in zip(rows, got):
            out[i] = g
    return out


def label_images(
    df: DataFrame,
    make_label_fn: Callable[[], Callable[[list[np.ndarray]], Sequence[str]]],
    image_col: str = "image",
    label_col: str = "emotion",
    error_col: str = "error",
) -> DataFrame:
    """Class name per picture from the caller's batch labeller, built once per
    Python worker. Output keeps the label-record contract: ``label`` xor
    ``error``. A batch that raises, or gives too few or too many labels, is
    retried picture by picture, so one bad picture only fails its own row; a
    picture without a label is an error."""
    keep = [c for c in df.columns if c != image_col]
    flat = df.select(*keep, *[F.col(f"{image_col}.{f}").alias(f"__img_{f}") for f in img.IMAGE_FIELDS])
    schema = T.StructType(
        [f for f in flat.schema.fields if not f.name.startswith("__img_")]
        + [T.StructField(label_col, T.StringType()), T.StructField(error_col, T.StringType())]
    )
    key = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from featureflow.operators.worker_cache import once

        label_fn = once(key, make_label_fn)

        def labels_of(arrays: list) -> list:
            try:
                got = list(label_fn(arrays))
                if len(got) != len(arrays):
                    raise ValueError(f"labeller returned {len(got)} labels for {len(arrays)} pictures")
                return got
            except Exception as e:  # noqa: BLE001
                return [e] if len(arrays) == 1 else [x for a in arrays for x in labels_of([a])]

        for pdf in batches:
            n = len(pdf)
            labels = np.empty(n, dtype=object)
            errors = np.empty(n, dtype=object)
            arrays, idx = [], []
            hh, ww, cc, mm, dd = img._image_columns(pdf)
            for i in range(n):
                try:
                    arrays.append(img.decode(hh[i], ww[i], cc[i], mm[i], dd[i]))
                    idx.append(i)
                except img.StageError as e:
                    errors[i] = str(e)
            for i, g in zip(idx, labels_of(arrays) if idx else []):
                if isinstance(g, Exception):
                    errors[i] = f"{type(g).__name__}: {g}"
                elif g is None:
                    errors[i] = "labeller gave no label"
                else:
                    labels[i] = str(g)
            res = pdf[[f.name for f in schema.fields[:-2]]].copy()
            res[label_col] = labels
            res[error_col] = errors
            yield res

    return flat.mapInPandas(run, schema)
