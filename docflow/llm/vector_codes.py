"""Vector codes: product quantisation of whole-number vectors in Hilbert-sorted flat blocks.

Each task cuts its rows into segments. Within a segment, each of the four parts of the
vectors is sorted along a Hilbert curve and cut into flat blocks, which store the box
around their members and the members' sum. A round looks at boxes first: distances
between box and entries leave a shortlist of entries for each block. A block with a
shortlist of one goes to that entry as a whole, with its stored sum; the others' members are
compared with the shortlist alone. All arithmetic is on whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import staged
from docflow.llm.vectors import common_length, is_usable, matrix, whole

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Rows of a segment and of a block.
SEGMENT, BLOCK = 8192, 32
#: Bits of each dimension on the Hilbert curve.
BITS = 4
#: Labels with more than this share of all rows are joined apart from the others: there
#: are fewer than its inverse.
HEAVY = 1 / 64
#: Up to here products of differences and their sums are exact as doubles.
_EXACT = 1 << 22
_LONG = (1 << 63) - 1


def hilbert_order(values: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The rows of a matrix of integers in the order of a Hilbert curve over their box."""
    n, d = values.shape
    low = values.min(0).astype(np.float64)
    span = np.maximum(values.max(0).astype(np.float64) - low, 1)
    x = np.minimum((values - low) / span * (1 << bits), (1 << bits) - 1).astype(np.uint32).T.copy()
    # Coordinates to the curve's index, bit by bit from the top: undo the turns ...
    for bit in range(bits - 1, 0, -1):
        q = np.uint32(1 << bit)
        mask = np.uint32(q - 1)
        for i in range(d):
            on = (x[i] & q) != 0
            swap = np.where(on, np.uint32(0), (x[0] ^ x[i]) & mask)
            x[0] ^= np.where(on, mask, swap)
            x[i] ^= swap
    # ... then the Gray code.
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.uint32)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[d - 1] & np.uint32(1 << bit), np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turn
    planes = [(x[i] >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1) for i in range(d)]
    packed = np.packbits(np.array(planes, np.uint8), axis=0)
    return np.lexsort(packed[::-1])


class Part:
    """One part of a segment's vectors: sorted members, and box and sum of each block."""

    def __init__(self, place: np.ndarray, members: np.ndarray):
        self.place, self.members = place, members
        self.starts = np.arange(0, len(members), BLOCK)
        self.ends = np.minimum(self.starts + BLOCK, len(members))
        self.low = np.minimum.reduceat(members, self.starts)
        self.high = np.maximum.reduceat(members, self.starts)
        self.sums = np.add.reduceat(members, self.starts)

    @classmethod
    def of(cls, values: np.ndarray) -> Part:
        place = hilbert_order(values)
        return cls(place, values[place])


def _common_type(*arrays: np.ndarray) -> type:
    """Doubles while all results are exact, Python's integers beyond."""
    most = max((max(abs(int(a.min())), abs(int(a.max()))) for a in arrays if a.size), default=0)
    return np.float64 if most < _EXACT else object


def shortlists(part: Part, entries: np.ndarray) -> np.ndarray:
    """Which entries can be nearest to a member of each block: a block by entry table.

    An entry is out if another is nearer to all points of the box: if its least distance
    exceeds the other's greatest, or if the box lies on the other's side of the plane
    between them. Of equally near entries the lower index stays.
    """
    kind = _common_type(part.low, part.high, entries)
    low, high, c = part.low.astype(kind), part.high.astype(kind), entries.astype(kind)
    below, above = c[None] - low[:, None], c[None] - high[:, None]
    least = (np.maximum(np.maximum(-below, above), 0) ** 2).sum(2)
    most = (np.maximum(np.maximum(below, -below), np.maximum(above, -above)) ** 2).sum(2)
    best = most.argmin(1)
    kept = least <= most.min(1)[:, None]
    # |x - c|^2 - |x - best|^2 is linear in x: its minimum over the box is at a corner.
    norms = (c * c).sum(1)
    away = c[None] - c[best][:, None]
    corner = np.maximum(away, 0) * high[:, None] + np.minimum(away, 0) * low[:, None]
    gap = norms[None] - norms[best][:, None] - 2 * corner.sum(2)
    index = np.arange(len(c))
    return kept & ((gap < 0) | ((gap == 0) & (index[None] <= best[:, None])) | (index[None] == best[:, None]))


def nearest(members: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """The nearest of the listed entries to each member, exactly; of equal ones the first."""
    kind = _common_type(members, entries)
    x, c = members.astype(kind), entries[listed].astype(kind)
    return listed[((c * c).sum(1)[None] - 2 * (x @ c.T)).argmin(1)]


def assign(part: Part, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of each member in sorted order, and the blocks that went to one as a whole."""
    kept = shortlists(part, entries)
    single = kept.sum(1) == 1
    chosen = np.repeat(np.where(single, kept.argmax(1), -1), part.ends - part.starts)
    for i in np.flatnonzero(~single).tolist():
        a, b = part.starts[i], part.ends[i]
        chosen[a:b] = nearest(part.members[a:b], entries, np.flatnonzero(kept[i]))
    return chosen, single


def _add(total: np.ndarray, counts: np.ndarray, part: Part, entries: np.ndarray) -> None:
    """Adds a part's members to the sums of their entries: blocks by their stored sums where they can."""
    chosen, single = assign(part, entries)
    counts += np.bincount(chosen, minlength=len(entries))
    whole_blocks = np.flatnonzero(single)
    np.add.at(total, chosen[part.starts[whole_blocks]], part.sums[whole_blocks].astype(total.dtype))
    others = np.repeat(~single, part.ends - part.starts)
    np.add.at(total, chosen[others], part.members[others].astype(total.dtype))


def _written(values: np.ndarray) -> bytes:
    small = not values.size or max(abs(int(values.min())), abs(int(values.max()))) < 1 << 31
    return (b"i" if small else b"l") + np.ascontiguousarray(values, "<i4" if small else "<i8").tobytes()


def _read(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, "<i4" if data[:1] == b"i" else "<i8", offset=1).reshape(-1, width).astype(np.int64)


def _segments(rows: DataFrame, width: int, size: int) -> DataFrame:
    """One row per segment: ids and labels, and of each part the sorted members with their places.

    Boxes and sums are those of 32 members each, one row of numbers per block and kind.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def segment() -> pa.RecordBatch:
            table = pa.Table.from_batches(kept).combine_chunks()
            values = np.zeros((table.num_rows, PARTS * size), np.int64)
            values[:, :width] = whole(matrix(table.column("embedding").chunk(0), width), SCALE)
            parts = [Part.of(values[:, p * size : (p + 1) * size]) for p in range(PARTS)]
            lists = [pa.array([table.column(c).to_pylist()], pa.list_(table.schema.field(c).type)) for c in ("vec_id", "label")]
            numbers = {
                "places": [p.place.astype("<i4").tobytes() for p in parts],
                "members": [_written(p.members) for p in parts],
                "lows": [_written(p.low) for p in parts],
                "highs": [_written(p.high) for p in parts],
                "sums": [_written(p.sums) for p in parts],
            }
            return pa.RecordBatch.from_arrays(
                [*lists, *(pa.array([v], pa.list_(pa.binary())) for v in numbers.values())], ["ids", "labels", *numbers]
            )

        count = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                kept.append(batch.slice(at, SEGMENT - count))
                count, at = count + kept[-1].num_rows, at + kept[-1].num_rows
                if count == SEGMENT:
                    yield segment()
                    kept, count = [], 0
        if count:
            yield segment()

    types = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    schema = f"ids array<{types['vec_id']}>, labels array<{types['label']}>, places array<binary>, members array<binary>"
    return rows.mapInArrow(cut, schema + ", lows array<binary>, highs array<binary>, sums array<binary>")


def _parts(batch: pa.RecordBatch, row: int, size: int) -> list[Part]:
    columns = {name: batch.column(name)[row].as_py() for name in ("places", "members", "lows", "highs", "sums")}
    parts = []
    for p in range(PARTS):
        part = Part.__new__(Part)
        part.place, part.members = np.frombuffer(columns["places"][p], "<i4"), _read(columns["members"][p], size)
        part.starts = np.arange(0, len(part.members), BLOCK)
        part.ends = np.minimum(part.starts + BLOCK, len(part.members))
        part.low, part.high, part.sums = (_read(columns[c][p], size) for c in ("lows", "highs", "sums"))
        parts.append(part)
    return parts


def _first_entries(rows: DataFrame, width: int, size: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids, in their order."""
    smallest = rows.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).collect()
    values = np.zeros((len(smallest), PARTS * size), np.int64)
    values[:, :width] = whole(np.array([r["embedding"] for r in smallest], np.float64), SCALE)
    return [values[:, p * size : (p + 1) * size] for p in range(PARTS)]


def _round(segments: DataFrame, books: list[np.ndarray], size: int) -> list[np.ndarray]:
    """The entries after one round: rounded-down means of the members that are nearest to each."""
    given = segments.sparkSession.sparkContext.broadcast(books)
    names = [f"{half}{i}" for half in ("high", "low") for i in range(size)]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in given.value]
        totals = [np.zeros((len(b), 2 * size), np.int64) for b in given.value]
        for batch in batches:
            for row in range(batch.num_rows):
                for p, part in enumerate(_parts(batch, row, size)):
                    once = np.zeros((len(given.value[p]), size), object if _common_type(part.members, part.low) is object else np.int64)
                    _add(once, counts[p], part, given.value[p])
                    totals[p][:, :size] += (once >> 31).astype(np.int64)
                    totals[p][:, size:] += (once & ((1 << 31) - 1)).astype(np.int64)
        for p, (n, total) in enumerate(zip(counts, totals, strict=True)):
            used = np.flatnonzero(n)
            columns = [np.full(len(used), p), used, n[used], *total[used].T]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "n", *names])

    schema = ", ".join(f"{c} long" for c in ("part", "entry", "n", *names))
    read = segments.select("places", "members", "lows", "highs", "sums")
    sums = read.mapInArrow(add_up, schema).groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in ("n", *names)))
    books = [b.copy() for b in books]
    for r in sums.collect():
        books[r["part"]][r["entry"]] = [((r[f"high{i}"] << 31) + r[f"low{i}"]) // r["n"] for i in range(size)]
    return books


def _codes(segments: DataFrame, books: list[np.ndarray], size: int, id_type: str, label_type: str) -> DataFrame:
    """``vec_id, label, code, error`` by the final entries."""
    given = segments.sparkSession.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                codes, errors = [], 0
                for part, book in zip(_parts(batch, row, size), given.value, strict=True):
                    chosen, _ = assign(part, book)
                    kind = _common_type(part.members, book)
                    off = part.members.astype(kind) - book[chosen].astype(kind)
                    code, error = np.empty(len(chosen), np.int64), np.empty(len(chosen), object)
                    code[part.place], error[part.place] = chosen, [int(e) for e in (off * off).sum(1)]
                    codes.append(code)
                    errors = errors + error
                text = ["%02x%02x%02x%02x" % c for c in zip(*(c.tolist() for c in codes), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[row].values,
                        batch.column("labels")[row].values,
                        pa.array(text),
                        pa.array([e if e <= _LONG else None for e in errors.tolist()], pa.int64()),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    return segments.mapInArrow(encode, f"vec_id {id_type}, label {label_type}, code string, error long")


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with the sum of ``error`` over the rows of the same label.

    Sums are aggregated before they are shuffled. Of the labels, those of very many rows
    are few and joined by broadcast, so that none of them comes together in a task.
    """
    sums = staged(coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("rows")), "label-errors")
    least = HEAVY * (sums.agg(F.sum("rows")).first()[0] or 0)
    heavy, light = (sums.where(F.expr(f"rows {sign} {least}")).select(F.col("label").alias("_label"), "label_error") for sign in (">", "<="))
    same = coded["label"].eqNullSafe(F.col("_label"))
    # Fewer than 64 labels have more than one 64th of the rows.
    often = coded.join(F.broadcast(heavy), same)
    seldom = coded.join(F.broadcast(heavy), same, "left_anti").join(light.hint("merge"), same)
    return often.unionByName(seldom).drop("_label")


def codebooks_text(books: list[np.ndarray]) -> str:
    return ",".join(str(int(c)) for book in books for entry in book for c in entry)


def compress(df: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per vector.

    Reads ``vec_id``, ``embedding`` and ``label``. Rows with a null or empty vector, or
    with null or non-finite components, are left out, and so are vectors of another
    length than most of the others have. A component ``x`` is taken as ``floor(1024 *
    x)``, at most 2^62 in size; a length that is no multiple of four is filled up with
    zeros. The first entries are the vectors with the smallest ids, nulls last, rows that
    repeat an id in the order of their vectors; fewer than 256 rows give fewer entries.
    Repeated rows count as often as they are there. Ties go to the lower entry. Null
    labels are one label. An error beyond a long is null and left out of the sums, and a
    sum beyond a long is null. No rows give no rows. Other columns are not read.
    """
    id_type, label_type = (df.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    rows = df.select("vec_id", "embedding", "label").where(is_usable(F.col("embedding")))
    width = common_length(rows, "embedding")
    if not width:
        schema = f"vec_id {id_type}, code string, error long, label_error long, codebooks_sha256 string"
        return df.sparkSession.createDataFrame([], schema)
    rows, size = rows.where(F.size("embedding") == width), -(-width // PARTS)
    segments = staged(_segments(rows, width, size), "segments")
    books = _first_entries(rows, width, size)
    for _ in range(rounds):
        books = _round(segments, books, size)
    coded = staged(_codes(segments, books, size, id_type, label_type), "codes")
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return _with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
