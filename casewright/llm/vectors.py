"""What the vector operators share: which vectors take part, classes of equal vectors, Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty, not zero and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & ~bad & some, F.lit(False))


def matrix(column: pa.Array, dims: int = 0) -> np.ndarray:
    """Lists as the rows of a matrix of doubles with ``dims`` columns at least; shorter lists end in zeros."""
    if not len(column):
        return np.zeros((0, dims))
    flat, size = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lengths(column)
    wide = max(dims, int(size.max()))
    if (size == wide).all():
        return flat.reshape(len(column), -1)
    out = np.zeros((len(column), wide))
    out[np.arange(wide) < size[:, None]] = flat
    return out


def lengths(column: pa.Array) -> np.ndarray:
    """How many components each list has."""
    return column.value_lengths().to_numpy(zero_copy_only=False)


def classes(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, n, v) for each different usable vector: its smallest id and how many rows have it. Null ids don't count."""
    good = rows.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
    return good.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n")).select("id", "n", "v")


def dimension(rows: DataFrame, vector_col: str) -> int:
    """The greatest length of the vectors of ``rows``; 0 without rows."""
    return rows.agg(F.max(F.size(vector_col))).first()[0] or 0
