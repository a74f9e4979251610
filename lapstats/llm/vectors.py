"""Integer vectors shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True where the vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def width(df: DataFrame, vector: str) -> int:
    """Length of the longest vector."""
    return df.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(column: pa.Array, columns: int) -> np.ndarray:
    """The rows of a list column as an int64 matrix; shorter vectors end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    size = np.diff(column.offsets.to_numpy())
    if (size == columns).all():
        return flat.reshape(len(size), columns)
    out = np.zeros((len(size), columns), np.int64)
    out[np.arange(columns) < size[:, None]] = flat
    return out
