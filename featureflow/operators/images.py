"""Image operators over Spark's image struct
(``origin, height, width, nChannels, mode, data``).

Pixels stay binary (no nested int lists). Each operator is one
``mapInPandas`` stage: Arrow batches of rows go to a Python worker, numpy does
the pixel work, and every row ends with a ``status`` instead of failing the
task. Only the image fields and the columns the stage needs cross the JVM /
Python boundary; callers select what they need first.

Supported modes (OpenCV type codes): 8-bit 1/3/4 channels (0, 16, 24) and
32-bit float 1/3/4 channels (5, 21, 29). Channel order is as stored; Spark's
image reader gives BGR.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.operators.arrow import binary_rows, rows_matrix
from featureflow.operators.columns import OK

IMAGE_FIELDS = ["origin", "height", "width", "nChannels", "mode", "data"]
IMAGE_TYPE = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])

_DEPTH = {np.dtype(np.uint8): 0, np.dtype(np.float32): 5}


class StageError(Exception):
    """A per-row failure: becomes the row's status, never a task failure."""


def mode_of(dtype: np.dtype, channels: int) -> int:
    return _DEPTH[np.dtype(dtype)] + (channels - 1) * 8


def decode(height, width, channels, mode, data) -> np.ndarray:
    if data is None or height is None or height < 0:
        raise StageError("undecodable")
    depth = int(mode) % 8
    if depth == 0:
        dtype = np.uint8
    elif depth == 5:
        dtype = np.float32
    else:
        raise StageError("unsupported_mode")
    arr = np.frombuffer(data, dtype=dtype)
    if arr.size != int(height) * int(width) * int(channels):
        raise StageError("bad_image")
    return arr.reshape(int(height), int(width), int(channels))


def encode(arr: np.ndarray) -> tuple[int, int, int, int, bytes]:
    h, w, c = arr.shape
    return h, w, c, mode_of(arr.dtype, c), np.ascontiguousarray(arr).tobytes()


def _to_dtype(values: np.ndarray, dtype) -> np.ndarray:
    if np.dtype(dtype) == np.uint8:
        return np.clip(np.floor(values + 0.5), 0, 255).astype(np.uint8)
    return values.astype(dtype)


# ---------------------------------------------------------------- pixel kernels (numpy)

def crop_xyxy(arr: np.ndarray, box: Sequence[int]) -> np.ndarray:
    """Rows y1..y2-1 and columns x1..x2-1, cut at the borders (negative values
    clamp to 0). An empty result is a per-row failure."""
    h, w = arr.shape[:2]
    x1, y1, x2, y2 = (int(v) for v in box)
    x1, x2 = min(max(x1, 0), w), min(max(x2, 0), w)
    y1, y2 = min(max(y1, 0), h), min(max(y2, 0), h)
    if x2 <= x1 or y2 <= y1:
        raise StageError("empty_crop")
    return arr[y1:y2, x1:x2]


def crop_xywh(arr: np.ndarray, box: Sequence[int]) -> np.ndarray:
    """Corners (x, y)-(x+w, y+h); pixels outside the picture are 0."""
    h, w = arr.shape[:2]
    x, y, bw, bh = (int(v) for v in box)
    if bw <= 0 or bh <= 0:
        raise StageError("empty_crop")
    out = np.zeros((bh, bw, arr.shape[2]), dtype=arr.dtype)
    sy0, sy1 = max(y, 0), min(y + bh, h)
    sx0, sx1 = max(x, 0), min(x + bw, w)
    if sy1 > sy0 and sx1 > sx0:
        out[sy0 - y:sy1 - y, sx0 - x:sx1 - x] = arr[sy0:sy1, sx0:sx1]
    return out


def nearest_index(src: int, dst: int) -> np.ndarray:
    """Source index of each target index: floor((i + 0.5) * src / dst), exact."""
    i = np.arange(dst, dtype=np.int64)
    return ((2 * i + 1) * src) // (2 * dst)


def resize_nearest(arr: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    dh, dw = size
    return arr[nearest_index(arr.shape[0], dh)][:, nearest_index(arr.shape[1], dw)]


def _bilinear_axis(src: int, dst: int):
    pos = (np.arange(dst) + 0.5) * src / dst - 0.5
    pos = np.clip(pos, 0, src - 1)
    lo = np.floor(pos).astype(np.int64)
    hi = np.minimum(lo + 1, src - 1)
    return lo, hi, pos - lo


def resize_bilinear(arr: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """Half-pixel-centre bilinear, clamped at the border, no anti-aliasing;
    8-bit output rounds half up."""
    dh, dw = size
    y0, y1, wy = _bilinear_axis(arr.shape[0], dh)
    x0, x1, wx = _bilinear_axis(arr.shape[1], dw)
    a = arr.astype(np.float64)
    top = a[y0][:, x0] * (1 - wx)[None, :, None] + a[y0][:, x1] * wx[None, :, None]
    bot = a[y1][:, x0] * (1 - wx)[None, :, None] + a[y1][:, x1] * wx[None, :, None]
    out = top * (1 - wy)[:, None, None] + bot * wy[:, None, None]
    return _to_dtype(out, arr.dtype)


def triangle(x: np.ndarray) -> np.ndarray:
    return np.maximum(1.0 - np.abs(x), 0.0)


def cubic(x: np.ndarray) -> np.ndarray:
    """Keys' cubic convolution with a = -0.5."""
    x = np.abs(x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, (((x - 5) * x + 8) * x - 4) * -0.5, 0.0))


#: Filter and its reach in pixels.
FILTERS = {"triangle": (triangle, 1.0), "bicubic": (cubic, 2.0)}
#: 8-bit pictures are weighted in whole numbers of 2**-WEIGHT_BITS.
WEIGHT_BITS = 22


@lru_cache(maxsize=16)
def resample_weights(src: int, dst: int, method: str) -> np.ndarray:
    """``dst`` x ``src`` weights, rows adding up to 1: the filter around each
    target's centre, widened by ``src / dst`` when shrinking so that every
    source pixel counts."""
    kernel, reach = FILTERS[method]
    wide = max(src / dst, 1.0)
    centre = (np.arange(dst) + 0.5) * (src / dst)
    first = np.maximum((centre - reach * wide + 0.5).astype(np.int64), 0)
    end = np.minimum((centre + reach * wide + 0.5).astype(np.int64), src)
    at = np.arange(src)
    w = kernel((at[None, :] - centre[:, None] + 0.5) * (1.0 / wide))
    w[(at < first[:, None]) | (at >= end[:, None])] = 0.0
    return w * (1.0 / np.cumsum(w, axis=1)[:, -1:])  # added up from left to right


def resample(arr: np.ndarray, size: tuple[int, int], method: str) -> np.ndarray:
    """Separable resampling, rows first and then columns, with the filter
    widened when shrinking. 8-bit pictures use whole-number weights and are
    rounded and clipped after each pass, so results are exact; the products are
    whole numbers under 2**53 and matrix products of doubles keep them so."""
    out = arr
    for axis, dst in ((1, size[1]), (0, size[0])):
        if out.shape[axis] == dst:
            continue
        w = resample_weights(out.shape[axis], dst, method)
        exact = arr.dtype == np.uint8
        if exact:
            scaled = w * (1 << WEIGHT_BITS)
            w = np.trunc(np.where(scaled < 0, scaled - 0.5, scaled + 0.5))
        out = np.moveaxis(np.tensordot(w, out.astype(np.float64), (1, axis)), 0, axis)
        if exact:
            out = np.clip(np.floor((out + (1 << WEIGHT_BITS - 1)) / (1 << WEIGHT_BITS)), 0, 255)
        out = out.astype(arr.dtype)
    return out


RESIZERS = {"nearest": resize_nearest, "bilinear": resize_bilinear,
            **{m: partial(resample, method=m) for m in FILTERS}}


# Luma weights of the blue, green and red channels, in thousandths.
LUMA_BGR = (114, 587, 299)


def gray(arr: np.ndarray, channels: int = 1) -> np.ndarray:
    """Luma of a BGR(A) picture (a one-channel picture is already grey), then
    repeated to ``channels``."""
    if arr.shape[2] == 1:
        g = arr
    elif arr.dtype == np.uint8:  # in whole numbers, halves up
        g = ((arr[..., :3].astype(np.int64) @ np.array(LUMA_BGR) + 500) // 1000).astype(np.uint8)[..., None]
    else:
        g = (arr[..., :3].astype(np.float64) @ (np.array(LUMA_BGR) / 1000)).astype(arr.dtype)[..., None]
    return np.repeat(g, channels, axis=2) if channels > 1 else g


def block_means(arr: np.ndarray, grid: int) -> np.ndarray:
    """Mean of each of grid x grid blocks (row-major, channel last); block
    edges at floor(k * size / grid)."""
    h, w, c = arr.shape
    if h < grid or w < grid:
        raise StageError("too_small")
    a = arr.astype(np.float64)
    ys = (np.arange(grid + 1) * h) // grid
    xs = (np.arange(grid + 1) * w) // grid
    out = np.empty((grid, grid, c))
    for i in range(grid):
        for j in range(grid):
            out[i, j] = a[ys[i]:ys[i + 1], xs[j]:xs[j + 1]].reshape(-1, c).mean(axis=0)
    return out.ravel()


def intensity_histogram(arr: np.ndarray, bins: int = 16) -> np.ndarray:
    """Share of pixels per intensity bin (8-bit range, or [0, 1] for floats)."""
    top = 256.0 if arr.dtype == np.uint8 else 1.0
    counts, _ = np.histogram(arr.astype(np.float64).ravel(), bins=bins, range=(0.0, top))
    return counts / max(arr.size, 1)


# ---------------------------------------------------------------- the stage runner

def _flat(df: DataFrame, image_col: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[F.col(f"{image_col}.{f}").alias(f"__img_{f}") for f in IMAGE_FIELDS])


def _struct_from_flat() -> Column:
    s = F.struct(*[F.col(f"__img_{f}").alias(f) for f in IMAGE_FIELDS])
    return F.when(F.col("__img_data").isNull(), F.lit(None).cast(IMAGE_TYPE)).otherwise(s)


def _row_args(pdf: pd.DataFrame, names: Sequence[str]) -> list:
    """Per-row ``{name: value}`` for the columns a kernel needs (read once per
    batch as numpy arrays, not row by row through pandas indexing)."""
    if not names:
        return [None] * len(pdf)
    cols = {a: pdf[a].to_numpy(dtype=object) for a in names}
    return [{a: cols[a][i] for a in names} for i in range(len(pdf))]


def _image_columns(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [pdf[f"__img_{f}"].to_numpy(dtype=object).copy() for f in IMAGE_FIELDS[1:]]


def _status_in(pdf: pd.DataFrame, status_col: str) -> np.ndarray:
    if status_col in pdf.columns:
        return pdf[status_col].fillna(OK).to_numpy(dtype=object)
    return np.full(len(pdf), OK, dtype=object)


def map_images(
    df: DataFrame,
    fn: Callable[[np.ndarray, dict | None], np.ndarray],
    image_col: str = "image",
    out: str | None = None,
    args: Sequence[str] = (),
    status_col: str = "status",
) -> DataFrame:
    """Apply ``fn(pixels, row_args) -> pixels`` to every picture, in one
    ``mapInPandas`` stage. Rows already failed keep their status and pass
    through; a failing row gets ``status`` = the error and a NULL image."""
    out = out or image_col
    keep = [c for c in df.columns if c != image_col]
    flat = _flat(df, image_col, keep)
    # every output field may be NULL (a failed row has no picture)
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in flat.schema.fields if f.name != status_col]
        + [T.StructField(status_col, T.StringType())]
    )
    # image fields keep their types; origin passes through
    arg_names = list(args)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = len(pdf)
            status = _status_in(pdf, status_col)
            hh, ww, cc, mm, dd = _image_columns(pdf)
            rows = _row_args(pdf, arg_names)
            for i in range(n):
                if status[i] != OK:
                    hh[i] = ww[i] = cc[i] = mm[i] = dd[i] = None
                    continue
                try:
                    arr = decode(hh[i], ww[i], cc[i], mm[i], dd[i])
                    res = fn(arr, rows[i])
                    hh[i], ww[i], cc[i], mm[i], dd[i] = encode(res)
                except StageError as e:
                    status[i] = str(e)
                    hh[i] = ww[i] = cc[i] = mm[i] = dd[i] = None
                except Exception as e:  # noqa: BLE001 - a bad row must not fail the task
                    status[i] = f"error: {type(e).__name__}: {e}"
                    hh[i] = ww[i] = cc[i] = mm[i] = dd[i] = None
            res_pdf = pdf.copy()
            res_pdf["__img_height"], res_pdf["__img_width"] = hh, ww
            res_pdf["__img_nChannels"], res_pdf["__img_mode"], res_pdf["__img_data"] = cc, mm, dd
            res_pdf[status_col] = status
            yield res_pdf[[f.name for f in schema.fields]]

    mapped = flat.mapInPandas(run, schema)
    cols = [c for c in keep if c != status_col and c != out]
    return mapped.select(*cols, _struct_from_flat().alias(out), status_col)


def map_image_values(
    df: DataFrame,
    fn: Callable[[np.ndarray, dict | None], np.ndarray],
    out: str,
    out_type: T.DataType = T.ArrayType(T.FloatType()),
    image_col: str = "image",
    args: Sequence[str] = (),
    status_col: str = "status",
    keep_image: bool = False,
    batch_fn: Callable[[list[np.ndarray]], list] | None = None,
) -> DataFrame:
    """Like ``map_images`` but ``fn`` returns a vector (features, flat pixels)
    stored in ``out``; the picture is dropped unless ``keep_image``. With
    ``batch_fn``, ``fn`` prepares each picture and ``batch_fn`` gets an Arrow
    batch's prepared pictures together; it returns a vector or an exception for
    each."""
    keep = [c for c in df.columns if c != image_col]
    flat = _flat(df, image_col, keep)
    base = [T.StructField(f.name, f.dataType, True) for f in flat.schema.fields
            if f.name != status_col and f.name != out]
    if not keep_image:
        base = [f for f in base if not f.name.startswith("__img_")]
    schema = T.StructType(base + [T.StructField(out, out_type), T.StructField(status_col, T.StringType())])
    elem = out_type.elementType if isinstance(out_type, T.ArrayType) else None
    np_type = np.float32 if isinstance(elem, T.FloatType) else np.float64
    arg_names = list(args)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = len(pdf)
            status = _status_in(pdf, status_col)
            vals = np.empty(n, dtype=object)
            hh, ww, cc, mm, dd = _image_columns(pdf)
            rows = _row_args(pdf, arg_names)
            for i in range(n):
                if status[i] != OK:
                    continue
                try:
                    arr = fn(decode(hh[i], ww[i], cc[i], mm[i], dd[i]), rows[i])
                    vals[i] = np.asarray(arr, dtype=np_type).ravel() if batch_fn is None else arr
                except StageError as e:
                    status[i] = str(e)
                except Exception as e:  # noqa: BLE001
                    status[i] = f"error: {type(e).__name__}: {e}"
            good = [i for i in range(n) if batch_fn is not None and status[i] == OK]
            for i, got in zip(good, batch_fn([vals[i] for i in good]) if good else []):
                if isinstance(got, Exception):
                    status[i], vals[i] = f"error: {type(got).__name__}: {got}", None
                else:
                    vals[i] = np.asarray(got, dtype=np_type).ravel()
            res = pdf.copy()
            res[out] = vals
            res[status_col] = status
            yield res[[f.name for f in schema.fields]]

    mapped = flat.mapInPandas(run, schema)
    cols = [c for c in keep if c != status_col and c != out]
    sel = [*cols]
    if keep_image:
        sel.append(_struct_from_flat().alias(image_col))
    return mapped.select(*sel, out, status_col)


# ---------------------------------------------------------------- operators

CROPPERS = {"xyxy": crop_xyxy, "xywh": crop_xywh}


def box_of(row: dict, box_col: str) -> Sequence[int]:
    """The row's box, or ``StageError('bad_bbox')`` when it is not four ints."""
    b = row[box_col]
    if b is None or len(b) != 4 or any(v is None for v in b):
        raise StageError("bad_bbox")
    return b


def crop(df: DataFrame, box_col: str = "bbox_coords", box: str = "xyxy", image_col: str = "image",
         out: str | None = None, status_col: str = "status") -> DataFrame:
    """Crop each picture by its box (``xyxy`` corners or ``xywh`` origin+size)."""
    kernel = CROPPERS[box]
    return map_images(df, lambda arr, row: kernel(arr, box_of(row, box_col)), image_col, out,
                      args=[box_col], status_col=status_col)


def crop_resize(df: DataFrame, box_col: str | None = "bbox_coords", box: str = "xyxy",
                size: int | tuple[int, int] = 128, method: str = "bilinear", gray_channels: int | None = None,
                image_col: str = "image", out: str | None = None, status_col: str = "status") -> DataFrame:
    """Crop (when ``box_col`` is given), resize and optionally grey in one
    stage: each picture crosses the Arrow boundary once, and the intermediate
    crop never leaves the Python worker. Same result as ``crop`` then
    ``resize`` (then ``to_gray``)."""
    hw = (size, size) if isinstance(size, int) else tuple(size)
    cropper, resizer = CROPPERS[box], RESIZERS[method]

    def fn(arr, row):
        if box_col is not None:
            arr = cropper(arr, box_of(row, box_col))
        arr = resizer(arr, hw)
        return gray(arr, gray_channels) if gray_channels else arr

    return map_images(df, fn, image_col, out, args=[box_col] if box_col else [], status_col=status_col)


def resize(df: DataFrame, size: int | tuple[int, int] = 128, method: str = "bilinear",
           image_col: str = "image", out: str | None = None, status_col: str = "status") -> DataFrame:
    """Resize to ``size`` (``(height, width)`` or a square side). ``nearest`` and
    ``bilinear`` read the pixels around each target; ``triangle`` and ``bicubic``
    weigh all pixels that a target covers."""
    hw = (size, size) if isinstance(size, int) else tuple(size)
    kernel = RESIZERS[method]
    return map_images(df, lambda arr, _: kernel(arr, hw), image_col, out, status_col=status_col)


def to_gray(df: DataFrame, channels: int = 1, image_col: str = "image", out: str | None = None,
            status_col: str = "status") -> DataFrame:
    """Grey picture with ``channels`` identical channels (1 or 3)."""
    return map_images(df, lambda arr, _: gray(arr, channels), image_col, out, status_col=status_col)


def to_pixels(df: DataFrame, image_col: str = "image", out: str = "pixels", status_col: str = "status",
              keep_image: bool = True) -> DataFrame:
    """Flat ``array<float>`` of the pixels (row-major, channel last); shape
    stays in the image struct (kept by default)."""
    return map_image_values(df, lambda arr, _: arr.astype(np.float32).ravel(), out,
                            T.ArrayType(T.FloatType()), image_col, status_col=status_col,
                            keep_image=keep_image)


def vectors_to_images(df: DataFrame, vector_col: str, height: int, width: int, channels: int = 1,
                      out: str = "image", origin: Column | None = None) -> DataFrame:
    """A float vector as a 32-bit float picture of the given shape (a vector of
    another length gives a NULL image)."""
    size = height * width * channels

    @F.arrow_udf(T.BinaryType())
    def to_bytes(v: pa.Array) -> pa.Array:
        valid, x = rows_matrix(v, size)
        return binary_rows(valid, x.astype("<f4"))

    data = to_bytes(F.col(vector_col))
    img = F.struct(
        (origin if origin is not None else F.lit("")).alias("origin"),
        F.lit(height).alias("height"), F.lit(width).alias("width"), F.lit(channels).alias("nChannels"),
        F.lit(mode_of(np.float32, channels)).alias("mode"), data.alias("data"),
    )
    return df.withColumn(out, img)
