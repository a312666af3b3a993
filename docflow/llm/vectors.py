"""Helpers for operators on whole-number vectors: usable rows, matrices, compact rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_usable(vector: Column) -> Column:
    """Whether a vector has components and all of them are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def common_length(df: DataFrame, column: str) -> int:
    """The length that most vectors have, the longest of such; 0 without rows."""
    sizes = df.groupBy(F.size(column).alias("length")).count()
    row = sizes.orderBy(F.desc("count"), F.desc("length")).first()
    return row["length"] if row else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of vectors of one length, without nulls, as doubles."""
    return np.asarray(column.flatten(), np.float64).reshape(len(column), width)


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * value)`` as 64-bit integers, at most 2^62 in size."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * values), -(2.0**62), 2.0**62).astype(np.int64)


def pack_rows(values: np.ndarray) -> pa.Array:
    """One binary per row of integers, with 16 bits each where all of the row fit, else 64.

    Equal rows have equal bytes, whatever stands beside them.
    """
    small = (np.abs(values) < 1 << 15).all(1)
    if small.all():
        data = np.ascontiguousarray(values, "<i2")
        offsets = np.arange(len(values) + 1, dtype=np.int32) * (2 * values.shape[1])
        return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    rows = [row.astype("<i2" if fits else "<i8").tobytes() for row, fits in zip(values, small.tolist(), strict=True)]
    return pa.array(rows, pa.binary())


def unpack_rows(column: pa.Array, width: int) -> np.ndarray:
    """The integers of packed rows."""
    rows = column.to_pylist()
    if all(len(r) == 2 * width for r in rows):
        return np.frombuffer(b"".join(rows), "<i2").reshape(len(rows), width).astype(np.int64)
    return np.array([np.frombuffer(r, "<i2" if len(r) == 2 * width else "<i8") for r in rows], np.int64)
