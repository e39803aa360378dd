"""Helpers for the operators on embedding vectors: integer components and exact products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Scaled components stay below this size, so that sums of squares of 64 differences fit into 64 bits.
LARGEST = 1 << 27
# Below this size products and squared distances of up to 128 components are whole numbers that a double holds exactly.
EXACT_DOUBLE = 1 << 22


def finite(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components (null for a null vector)."""
    return F.forall(vector.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component. A component beyond LARGEST fails the job: its squares would not fit."""
    def one(x: Column) -> Column:
        y = F.floor(x * F.lit(float(scale)))
        return F.when(F.abs(x * F.lit(float(scale))) < F.lit(float(LARGEST)), y.cast("int")).otherwise(
            F.raise_error(F.lit(f"a vector component times {scale} is beyond {LARGEST}")).cast("int"))
    return F.transform(vector.cast("array<double>"), one)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list column, all of length ``dims``, as int32."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False).reshape(-1, dims)


def unpack(data, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(-1, dims)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products (int64) of the integer rows of ``left`` with those of ``right``."""
    largest = max(np.abs(left).max(initial=0), np.abs(right).max(initial=0))
    if largest < EXACT_DOUBLE and left.shape[1] <= 128:  # whole numbers below 2^53: no sum is rounded, in any order
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left.astype(np.int64) @ right.T.astype(np.int64)


__all__ = ["EXACT_DOUBLE", "LARGEST", "finite", "matrix", "products", "scaled", "unpack"]
