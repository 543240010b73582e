"""Helpers for columns of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite(df: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is not null and has finite entries only."""
    v = F.col(column)
    return df.filter(v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def dense(column: pa.Array, dim: int) -> np.ndarray:
    """A list column without nulls as a matrix of doubles, shorter vectors
    filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if (lengths == dim).all():
        return flat.reshape(len(column), dim)
    out = np.zeros((len(column), dim))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(flat.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def scaled_floor(x: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x) as integers; results beyond ``limit`` either way count
    as the limit."""
    return np.clip(np.floor(scale * x), -limit, limit).astype(np.int64)


def dimension(df: DataFrame, column: str) -> int:
    """Length of the longest vector."""
    return df.agg(F.max(F.size(column))).first()[0] or 0
