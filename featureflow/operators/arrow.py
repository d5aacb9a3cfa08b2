"""Helpers for Arrow UDFs: fixed-length list columns as numpy matrices and
back, straight from the Arrow buffers (no per-row Python objects)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def rows_matrix(col: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """``(valid, x)``: which rows hold a list of length ``d``, and those lists
    as an ``n_valid x d`` float64 matrix (NULL elements become NaN)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    lens = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    valid = lens == d
    starts = col.offsets.to_numpy(zero_copy_only=False)[:-1][valid]
    vals = col.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if len(starts) == 0:
        return valid, np.empty((0, d))
    if np.all(np.diff(starts) == d):  # contiguous: one slice, one reshape
        return valid, vals[starts[0]: starts[0] + len(starts) * d].reshape(-1, d)
    return valid, vals[starts[:, None] + np.arange(d)[None, :]]


def binary_rows(valid: np.ndarray, rows: np.ndarray) -> pa.Array:
    """A binary array with one value per row: the bytes of the next row of
    ``rows`` where ``valid``, NULL elsewhere."""
    n = len(valid)
    width = rows.shape[1] * rows.dtype.itemsize if rows.ndim == 2 else 0
    offsets = np.concatenate([[0], np.cumsum(np.where(valid, width, 0))]).astype(np.int32)
    bitmap = pa.array(valid, type=pa.bool_()).buffers()[1]
    data = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    return pa.Array.from_buffers(pa.binary(), n, [bitmap, pa.py_buffer(offsets.tobytes()), data],
                                 null_count=int(n - valid.sum()))
