"""Reading vectors out of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite_vector(col: str) -> Column:
    """True for a non-empty array without null, NaN or infinite components."""
    v = F.col(col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(F.size(v) > 0, F.lit(False)) & F.coalesce(~bad, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The rows of a list column without nulls, all of one length, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)
