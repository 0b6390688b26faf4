"""Vectors in whole numbers, as the operators that count exactly read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SCALE = 256
LARGEST = 2**22  # so that sums of products of whole components stay exact


def whole_vectors(vectors: DataFrame, *more: str) -> DataFrame:
    """vec_id, the columns `more` and `whole`, the components as floor(256 * x).

    Vectors that are null or hold a null or a component that is not finite are left out, and so are
    those with a component of 16,384 or more either way, whose products could overflow.
    """
    own = vectors.select("vec_id", *more, F.col("embedding").cast("array<double>").alias("_v"))
    small = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / SCALE))
    whole = F.transform("_v", lambda x: F.floor(x * SCALE).cast("int"))
    return own.filter(F.col("_v").isNotNull() & small).select("vec_id", *more, whole.alias("whole"))


def one_length(rows: DataFrame, first: Column | int) -> DataFrame:
    """The rows whose vector has as many components as `first` says."""
    return rows.filter(F.size("whole") == first)


def integers(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of one length as the rows of an int64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as lists."""
    rows = len(matrix)
    flat = np.ascontiguousarray(matrix).reshape(rows, -1) if rows else matrix.reshape(0, 0)
    starts = np.arange(rows + 1, dtype=np.int32) * (flat.shape[1] if rows else 0)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(flat.ravel(), kind))
