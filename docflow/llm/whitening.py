"""Embedding whitening: exact sums in Spark, spectrum slicing of the covariance.

Vectors become whole numbers. The distinct ones are written once; two passes over them
give their sums and, centred at the whole number next to each mean, the sums of their
products. Every partial sum is a whole number that a double holds, so that neither the
order of the tasks nor a repeated task changes a result. The driver holds one
covariance matrix, whose size does not depend on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import staged
from docflow.llm.spectrum import leading
from docflow.llm.vectors import common_length, is_usable, matrix, pack_rows, unpack_rows, whole

SCALE, MOST_COMPONENTS = 64, 16
#: Rows that are multiplied at once.
ROWS = 4096
_LOW = (1 << 31) - 1
_LONG = (1 << 63) - 1


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for part in _parts(batches):
            x = unpack_rows(part.column(0), width)
            n, high, low = n + len(x), high + (x >> 31).sum(0), low + (x & _LOW).sum(0)
        if n:
            columns = [pa.array(c, pa.int64()) for c in (range(width), [n] * width, high, low)]
            yield pa.RecordBatch.from_arrays(columns, ["dimension", "n", "high", "low"])

    parts = fit.mapInArrow(add, "dimension long, n long, high long, low long").groupBy("dimension")
    rows = parts.agg(*(F.sum(c).alias(c) for c in ("n", "high", "low"))).orderBy("dimension").collect()
    return (rows[0]["n"], [(r["high"] << 31) + r["low"] for r in rows]) if rows else (0, [])


def _products(fit: DataFrame, size: int, rows_of) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of products of the columns that ``rows_of`` makes of packed rows."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((size + 1, size)), 0
        for part in _parts(batches):
            y = rows_of(part.column(0))
            total[:size] += y.T @ y
            total[size] += y.sum(0)
            n += len(y)
        if n:
            i, j = np.nonzero(np.tri(size + 1, size, dtype=bool))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "value"])

    found = fit.mapInArrow(multiply, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros((size + 1, size))
    total[found["i"], found["j"]] = found["value"]
    products = np.tril(total[:size])
    return total[size], products + np.tril(products, -1).T


class Whitening:
    """Centre and components of a fit list, and what it measures of whitened rows."""

    def __init__(self, fit: DataFrame, width: int, most: int):
        self.width = width
        self.n, sums = _sums(fit, width)
        self.center = [floor(Fraction(2 * s + self.n, 2 * self.n)) for s in sums]
        #: ``sums`` less ``n`` times the centre: at most half of ``n`` in size.
        self.rest = [s - self.n * c for s, c in zip(sums, self.center, strict=True)]
        self.shift = np.array([float(Fraction(r, self.n)) for r in self.rest])
        _, products = _products(fit, width, lambda column: self.centred(unpack_rows(column, width)).astype(np.float64))
        covariance = products / self.n - np.outer(self.shift, self.shift)
        self.values, self.vectors = leading(covariance, most)
        trace = float(np.trace(covariance))
        self.explained = self.values / trace if trace > 0 else self.values
        self.projection = self.vectors / np.sqrt(self.values)
        self.identity_error = self._identity_error(fit)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Whole numbers less the centre; a difference beyond 64 bits stays at their end."""
        center = np.array(self.center, np.int64)
        if len(x) and max(abs(int(x.min())), abs(int(x.max()))) >= 1 << 61:
            return np.array([[max(-_LONG, min(_LONG, int(a) - c)) for a, c in zip(row, self.center, strict=True)] for row in x], np.int64)
        return x - center

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return (y - self.shift) @ self.projection

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """``sum((n * x - S)^2)`` of each centred row; None where a long can't hold it."""
        n, rest = self.n, np.array(self.rest, np.int64)
        fixed = sum(r * r for r in self.rest)
        if self.width * n < 1 << 36 and (not len(y) or int(np.abs(y).max()) < 1 << 24):
            squares, mixed = (y * y).sum(1).tolist(), (y @ rest).tolist()
        else:
            big = y.astype(object)
            squares, mixed = (big * big).sum(1).tolist(), (big @ rest.astype(object)).tolist()
        exact = (n * n * a - 2 * n * b + fixed for a, b in zip(squares, mixed, strict=True))
        return [d if d <= _LONG else None for d in exact]

    def _identity_error(self, fit: DataFrame) -> float:
        """The largest entry, in size, of the measured covariance of whitened rows less the identity."""
        count = len(self.values)
        if not count:
            return 0.0
        sums, products = _products(fit, count, lambda column: self.whitened(self.centred(unpack_rows(column, self.width))))
        return float(np.abs(products / self.n - np.outer(sums, sums) / self.n**2 - np.eye(count)).max())


def whiten(df: DataFrame, most: int = MOST_COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component.

    Reads ``vec_id`` and ``embedding``. Rows with a null or empty vector, or with null or
    non-finite entries, are left out, and so are vectors of another length than most of
    the others have. An entry ``c`` is taken as ``floor(64 * c)``, at most 2^62 in size.
    The fit list has each distinct vector once, so repeated rows and copies don't change
    it; each row of the input, also one with a null or repeated id, gets its own results.
    Components whose variance is no more than rounding error are not numbered: one vector
    alone, or none, gives no rows. Equal eigenvalues are numbered in the order in which
    they are found. A ``deviation`` beyond a long is null. Other columns are not read.
    """
    id_type = df.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = df.select("vec_id", "embedding").where(is_usable(F.col("embedding")))
    width = common_length(rows, "embedding")
    if not width:
        return df.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("embedding") == width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays([pack_rows(whole(matrix(part.column(0), width), SCALE))], ["x"])

    fit = staged(rows.select("embedding").mapInArrow(pack, "x binary").distinct(), "fit-list")
    model = df.sparkSession.sparkContext.broadcast(Whitening(fit, width, most))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        count = len(w.values)
        for part in _parts(batches) if count else ():
            y = w.centred(whole(matrix(part.column("embedding"), width), SCALE))
            each = np.repeat(np.arange(len(y)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(y))),
                    pa.array(np.full(len(each), w.n, np.int64)),
                    pa.array(w.deviations(y), pa.int64()).take(pa.array(each)),
                    pa.array(w.whitened(y).ravel()),
                    pa.array(np.tile(w.explained, len(y))),
                    pa.array(np.full(len(each), w.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(apply, schema)
