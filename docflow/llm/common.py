"""Helpers shared by the operators: batches of text as numpy arrays, staged tables.

Words are runs of bytes other than the six ASCII white-space characters; A to Z
count as a to z. Everything below works on the UTF-8 bytes of an Arrow column, so
no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import scratch_dir

#: What separates words, as a regular expression for SQL and Spark.
WORD = r"[^\x20\x09-\x0D]+"
#: Words of a shingle; texts with fewer words are one shingle.
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
_PLACE = np.random.default_rng(11).integers(1, 1 << 63, SHINGLE + 1, np.uint64) | np.uint64(1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read back.

    Cuts the lineage: what is built on it is computed from the written files, also
    after an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_fold(column, held_out: bool = True):
    """Whether a document is held out from training: crc32 of its id, modulo 4, is 2."""
    is_held = F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return is_held if held_out else ~is_held


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values in place, so that all their bits depend on all others."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


@lru_cache(2)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``max_bytes`` of text; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > max_bytes:
            yield batch.slice(start, i - start)
            total, start = 0, i
        total += size + 64
    if start < batch.num_rows:
        yield batch.slice(start)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and where each row's begin and end."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word; the index of each row's first word."""
    solid = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, A to Z as a to z."""
    size = 1 << max(20, int(len(data)).bit_length())
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * _powers(_BASE, size)[: len(data)], out=running[1:])
    h = (running[ends] - running[starts]) * _powers(_INVERSE, size)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its shingles; empty without words."""
    data, offsets = utf8(column)
    starts, ends, bounds = word_spans(data, offsets)
    words = hash_spans(data, starts, ends)
    n = len(words)
    rolled = np.zeros(max(0, n - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        rolled += words[j : j + len(rolled)] * _PLACE[j]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            sets.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            short = np.concatenate([words[a:b] * _PLACE[: b - a], _PLACE[SHINGLE:] * np.uint64(b - a)])
            sets.append(mix(short.sum(dtype=np.uint64, keepdims=True)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


@lru_cache(4)
def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(3)
    return draw.integers(1, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, count, np.uint64)


def minhash(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``count`` minima per set, one per universal hash function; all ones for an empty set."""
    out = np.full((len(sets), count), 0xFFFFFFFF, np.uint32)
    full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    if not len(full):
        return out
    values = np.concatenate([sets[i] for i in full])
    bounds = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
    for k, (a, b) in enumerate(zip(*_permutations(count), strict=True)):
        out[full, k] = np.minimum.reduceat((values * a + b) >> np.uint64(32), bounds)
    return out
