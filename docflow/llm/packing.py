"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

A piece of ``n`` tokens costs ``LINEAR * n + n * n``: the projections and its own
attention. Each task tokenizes its share of the documents and packs it window by
window: descending pieces go to the sequence of the lowest cost that still has room,
and what fits nowhere is cut to fill the gaps. Nothing is shuffled, and a task holds
one window of ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import slices
from docflow.llm.tokens import SLICE, tokenizer

CAPACITY = 4096
#: Tokens packed at a time, in sequences.
WINDOW = 256
#: Cost of a token besides attention, in units of one pair of tokens.
LINEAR = 4096
END_ID = 2
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

#: Document, first token in it, number of tokens.
Piece = tuple[int, int, int]


def balance(pieces: list[Piece], sequences: int, capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Fills ``sequences`` with ``pieces`` shorter than ``capacity``; also returns the rest.

    If there are tokens enough, all sequences are full. Equal pieces are taken in their order.
    """
    cost, room = np.zeros(sequences), np.full(sequences, capacity)
    filled: list[list[Piece]] = [[] for _ in range(sequences)]
    unplaced = []

    def put(at: int, piece: Piece) -> None:
        filled[at].append(piece)
        room[at] -= piece[2]
        cost[at] += LINEAR * piece[2] + piece[2] * piece[2]

    for piece in sorted(pieces, key=lambda p: -p[2]):
        fitting = np.where(room >= piece[2], cost, np.inf)
        at = int(fitting.argmin()) if sequences else 0
        if sequences and fitting[at] < np.inf:
            put(at, piece)
        else:
            unplaced.append(piece)
    rest = []
    for doc, start, length in unplaced:
        while length and sequences and room.max() > 0:
            at = int(room.argmax())
            part = min(length, int(room[at]))
            put(at, (doc, start, part))
            start, length = start + part, length - part
        if length:
            rest.append((doc, start, length))
    return filled, rest


def powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces in sequences whose lengths are powers of two, largest first."""
    total = sum(p[2] for p in pieces)
    todo, out = list(reversed(pieces)), []
    for bit in reversed(range(total.bit_length())):
        room = total & 1 << bit
        sequence = []
        while room:
            doc, start, length = todo.pop()
            part = min(length, room)
            sequence.append((doc, start, part))
            room -= part
            if length > part:
                todo.append((doc, start + part, length - part))
        if sequence:
            out.append(sequence)
    return out


class _Packer:
    """The sequences of one task, numbered from ``first``."""

    def __init__(self, first: int, capacity: int, window: int):
        self.number, self.capacity, self.window = first, capacity, window
        self.docs: dict[int, tuple[int | None, np.ndarray]] = {}
        self.pieces: list[Piece] = []
        self.held = self.seen = 0

    def _batch(self, sequences: list[list[Piece]]) -> pa.RecordBatch:
        rows, ids = [], []
        for sequence in sequences:
            offset = 0
            for doc, start, length in sequence:
                doc_id, tokens = self.docs[doc]
                rows.append((doc_id, start, length, len(tokens), self.number, offset))
                ids.append(tokens[start : start + length].astype("<u4").tobytes())
                offset += length
            self.number += 1
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        arrays = [pa.array(c, pa.int64()) for c in columns]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(ids, pa.binary())], names)

    def add(self, doc_id: int | None, tokens: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc, self.seen = self.seen, self.seen + 1
        self.docs[doc] = (doc_id, tokens)
        whole = len(tokens) // self.capacity
        if whole:
            yield self._batch([[(doc, i * self.capacity, self.capacity)] for i in range(whole)])
        if len(tokens) > whole * self.capacity:
            self.pieces.append((doc, whole * self.capacity, len(tokens) - whole * self.capacity))
            self.held += len(tokens) - whole * self.capacity
        if self.held >= self.window * self.capacity:
            yield from self.flush()

    def flush(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        filled, rest = balance(self.pieces, self.held // self.capacity, self.capacity)
        yield self._batch(filled)
        if last:
            yield self._batch(powers(rest))
            rest = []
        self.pieces, self.held = rest, sum(p[2] for p in rest)
        self.docs = {p[0]: self.docs[p[0]] for p in rest}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document, with its place in a sequence and its ``ids``.

    ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``: the piece has
    ``length`` of the document's ``doc_tokens`` ids, from ``start``, and stands in the
    sequence from ``offset``; ``ids`` are unsigned 32-bit and little-endian. Documents
    end with ``end_id``; a null or empty text is that id alone. All sequences have
    ``capacity`` tokens but a few at the end of a partition, whose lengths are powers of
    two: nothing is padded. Longer documents are cut. Rows without id and repeated rows
    are documents like others; other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path, False)
        end = np.array([end_id], encoder.dtype)
        packer = _Packer(TaskContext.get().partitionId() << 32, capacity, window)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text").to_pylist()
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    yield from packer.add(doc_id, np.concatenate([np.frombuffer(ids, encoder.dtype), end]))
        yield from packer.flush(last=True)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
