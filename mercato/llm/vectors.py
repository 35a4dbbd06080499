"""Integer vectors, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integers up to here are exact as doubles.
EXACT = 1 << 53


def usable(vector: str) -> Column:
    """The vector is there, and so are all its components, as finite numbers."""
    v = F.col(vector)
    infinite = F.lit(float("inf"))
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))


def integer_vectors(df: DataFrame, columns: Sequence[str], vector: str, scale: int = 256) -> DataFrame:
    """``columns`` and ``q``, the components as floor(scale * x), of the rows
    with a usable vector.  A component beyond 32 bits is an error."""
    q = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("int"))
    return df.where(usable(vector)).select(*columns, q.alias("q"))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of integers as the rows of a matrix; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.zeros((0, width), dtype=np.int64)
    offs = np.asarray(column.offsets).astype(np.int64)
    flat = np.asarray(column.values).astype(np.int64)
    size = np.diff(offs)
    if len(size) and (size == width).all():
        return flat[offs[0]:offs[-1]].reshape(len(size), width)
    out = np.zeros((len(size), width), dtype=np.int64)
    for i in range(len(size)):
        out[i, :size[i]] = flat[offs[i]:offs[i + 1]]
    return out
