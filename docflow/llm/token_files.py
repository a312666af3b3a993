"""Token ids in files of Simple-8b words.

A word of 64 bits has a selector in its highest four bits; the other 60 hold as many
ids as the selector says, each with the same number of bits. Ids of more than 60 bits
are escapes: a word with nothing but its selector stands for the next value of a list.
A block of ids begins with a word of its own, and the file has the offset of each, so
that blocks can be read alone and whole files without a loop over words.

The files are rows of a Parquet table, which any store that Spark writes to can hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import slices
from docflow.llm.tokens import SLICE, tokenizer

#: Ids of a word by selector: fixed values of the format, as their bits: 60 // count.
COUNTS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
WIDTHS = 60 // COUNTS
ESCAPE = 15
BLOCK = 4096
MAGIC = 0x31423853
#: Ids of a file, at least, but for the last one of a shard.
FILE_IDS = 1 << 20
FILE_SCHEMA = "shard int, file int, first long, n_ids long, doc_ids array<bigint>, payload binary"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits of each value, at least one; one too many for some above 2 ** 53."""
    return np.maximum(np.frexp(values.astype(np.float64))[1], 1)


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the offset of each block's first word, and the escapes of unsigned integers."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    bits = _bits(values).astype(np.int8)
    ends = np.minimum(np.arange(n) // block * block + block, n)
    selector = np.zeros(n, np.int8)
    selector[bits > 60] = ESCAPE
    # Selectors wide enough for every id fit wherever enough ids follow.
    always = [s for s in range(len(COUNTS)) if n and WIDTHS[s] >= bits.max()]
    left = ends - np.arange(n)
    for s in always:
        selector[left >= COUNTS[s]] = s
    count = int(COUNTS[always[-1]]) if always else 1
    at = np.flatnonzero((left >= count) & (bits <= 60))
    within = bits.copy()
    for k in range(1, count):
        np.maximum(within[:-k], bits[k:], out=within[:-k])
    widest = within[at]
    # Where more ids fit with fewer bits each, fewer ids fit, too: candidates only shrink.
    for s in range(len(always) or 1, len(COUNTS)):
        few = widest <= WIDTHS[s]
        at, widest = at[few], widest[few]
        while count < COUNTS[s] and len(at):
            inside = at + count < ends[at]
            at = at[inside]
            widest = np.maximum(widest[inside], bits[at + count])
            few = widest <= WIDTHS[s]
            at, widest, count = at[few], widest[few], count + 1
        if not len(at):
            break
        selector[at] = s
    step = np.append(COUNTS, [1, 1])[selector]
    # All blocks at once, from word to word.
    begins = np.zeros(n + 1, bool)
    at = np.arange(0, n, block)
    ends = ends[at]
    while len(at):
        begins[at] = True
        at = at + step[at]
        more = at < ends
        at, ends = at[more], ends[more]
    starts = np.flatnonzero(begins)
    chosen = selector[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (count, width) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist(), strict=True)):
        own = np.flatnonzero(chosen == s)
        for k in range(count if len(own) else 0):
            words[own] |= values[starts[own] + k] << np.uint64(k * width)
    return words, np.searchsorted(starts, np.arange(0, n, block)).astype(np.uint32), values[starts[chosen == ESCAPE]]


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The values of words as ``encode`` gives them."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.append(COUNTS, [1, 1])[chosen]
    at = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(int(at[-1]), np.uint64)
    for s, (count, width) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist(), strict=True)):
        own = np.flatnonzero(chosen == s)
        mask = np.uint64((1 << width) - 1)
        for k in range(count if len(own) else 0):
            out[at[own] + k] = (words[own] >> np.uint64(k * width)) & mask
    out[at[:-1][chosen == ESCAPE]] = escapes
    return out


@dataclass
class TokenFile:
    """The content of one file: all its ids and how many each document has."""

    lengths: np.ndarray
    block: int
    offsets: np.ndarray
    words: np.ndarray
    escapes: np.ndarray

    @classmethod
    def of(cls, documents: list[np.ndarray], block: int = BLOCK) -> TokenFile:
        lengths = np.array([len(d) for d in documents], np.uint32)
        words, offsets, escapes = encode(np.concatenate(documents) if documents else np.zeros(0, np.uint64), block)
        return cls(lengths, block, offsets, words, escapes)

    def to_bytes(self) -> bytes:
        head = np.array([MAGIC, self.block, len(self.lengths), len(self.offsets), len(self.words), len(self.escapes)], "<u4")
        parts = (head, self.lengths.astype("<u4"), self.offsets.astype("<u4"), self.words.astype("<u8"), self.escapes.astype("<u8"))
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data) -> TokenFile:
        magic, block, docs, blocks, words, escapes = np.frombuffer(data, "<u4", 6).tolist()
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = 24
        arrays = []
        for kind, n in (("<u4", docs), ("<u4", blocks), ("<u8", words), ("<u8", escapes)):
            arrays.append(np.frombuffer(data, kind, n, at))
            at += arrays[-1].nbytes
        return cls(arrays[0], block, *arrays[1:])

    def ids(self) -> np.ndarray:
        return decode(self.words, self.escapes)

    def block_ids(self, i: int) -> np.ndarray:
        """The ids of one block, without reading the others."""
        end = self.offsets[i + 1] if i + 1 < len(self.offsets) else len(self.words)
        before = np.count_nonzero(self.words[: self.offsets[i]] >> np.uint64(60) == ESCAPE) if len(self.escapes) else 0
        words = self.words[self.offsets[i] : end]
        count = np.count_nonzero(words >> np.uint64(60) == ESCAPE)
        return decode(words, self.escapes[before : before + count])


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, file_ids: int = FILE_IDS) -> None:
    """Writes the ids of all documents, in ascending order of ``doc_id``, below ``path``.

    Each document ends with ``end_id``; a null or empty text is that id alone. Documents
    without id come first, equal ids in the order of their texts. A file has whole
    documents. ``first`` is its first id's place in its shard; shards follow each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path, True)
        end = np.array([end_id], encoder.dtype)
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        held, names, count = [], [], 0

        def file() -> pa.RecordBatch:
            arrays = [[shard], [number], [first], [count], [names], [TokenFile.of(held).to_bytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            fields = ["shard", "file", "first", "n_ids", "doc_ids", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], fields)

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text").to_pylist()
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    held.append(np.concatenate([np.frombuffer(ids, encoder.dtype), end]))
                    names.append(doc_id)
                    count += len(held[-1])
                    if count >= file_ids:
                        yield file()
                        number, first = number + 1, first + count
                        held, names, count = [], [], 0
        if names:
            yield file()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files below ``path``.

    ``start`` counts the ids of all documents before it; ``ids`` are unsigned 32-bit
    and little-endian, with the end id. No files give no rows.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    # One row per shard, whatever the number of documents.
    before = F.sum("n_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    starts = shards.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))
    placed = files.join(F.broadcast(starts), "shard").select((F.col("shard_start") + F.col("first")).alias("start"), "doc_ids", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, doc_ids, payload in zip(*batch.columns, strict=True):
                file = TokenFile.from_bytes(payload.as_buffer())
                bounds = np.concatenate([[0], np.cumsum(file.lengths, dtype=np.int64)])
                ids = file.ids().astype("<u4")
                sizes = pa.array(file.lengths.astype(np.int64))
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds * 4), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(bounds[:-1] + start.as_py()), sizes, data.cast(pa.binary())], ["doc_id", "start", "n_tokens", "ids"]
                )

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
