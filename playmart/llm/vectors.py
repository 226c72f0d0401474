"""Integer vectors: what the vector operators read from a table of embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256.0
EXACT = 1 << 53  # doubles hold every integer up to here


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its entries are finite numbers."""
    finite = lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf")))
    # NaN is larger than any number to Spark
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def scaled(vector: Column) -> Column:
    """floor(256 c) of every entry c, as long integers; never a negative zero."""
    return F.transform(vector, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("bigint"))


def filled(vector: Column, width: int) -> Column:
    """A shorter vector gets zeros at its end."""
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(vector))
    return F.when(F.size(vector) >= width, vector).otherwise(F.concat(vector, zeros))


def widest(rows: DataFrame, column: str) -> int:
    """The largest number of entries; zero for an empty table."""
    return rows.agg(F.max(F.size(column))).first()[0] or 0


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of lists of `width` integers as an array with a row for each."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array(
            [], column.type)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer arrays, exactly: as doubles where no sum can
    leave the integers that these hold, else as long integers. Products that may leave the range of
    long are an error, not a wrong result."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    most = float(np.abs(left.astype(np.float64)).max()) * float(
        np.abs(right.astype(np.float64)).max()) * left.shape[1]
    if most < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if most >= 1 << 63:
        raise OverflowError("inner products beyond the range of long")
    return left @ right.T
