"""The bytes of listed documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docflow.schemas import LISTING_SCHEMA
from docflow.session import ship_package
from docflow.sources.dealing import deal_by_size
from docflow.sources.filesystem import mapped_file, read_file
from docflow.sources.listing import list_documents

# Fixed value: the most bytes that one value of a Spark column can have.
LONGEST_VALUE = 2**31 - 16
# Bytes of files that a task holds before it hands them over.
FLUSH_BYTES = 16 << 20

_CONTENT = T.StructType([*LISTING_SCHEMA.fields, T.StructField("content", T.BinaryType(), True)])


def _mapped(path: str) -> pa.Array:
    """The content of one large file, as one value; null if it can't be read, or has grown beyond what a value can hold."""
    try:
        found = mapped_file(path)
    except OSError:
        found = None
    if found is None or found.size > LONGEST_VALUE:
        return pa.nulls(1, pa.binary())
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, found.size], np.int32)), found])


def with_contents(
    names: pa.RecordBatch, longest: int = LONGEST_VALUE, read: Callable[[str], bytes] = read_file
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Some rows of a listing after others, with their contents.

    Contents are null for what is no file, can't be read or has more than ``longest`` bytes.
    ``FLUSH_BYTES`` at most are held; a larger file is on its own, and mapped.
    """
    columns = (names.column(c).to_pylist() for c in ("document_path", "file_size", "is_file"))
    contents: list[bytes | None] = []
    start = held = 0
    for row, (path, size, is_file) in enumerate(zip(*columns, strict=True)):
        size = size or 0
        wanted = is_file and size <= longest
        if contents and wanted and held + size > FLUSH_BYTES:
            yield names.slice(start, row - start), pa.array(contents, pa.binary())
            contents, start, held = [], row, 0
        if wanted and size > FLUSH_BYTES:
            yield names.slice(row, 1), _mapped(path)
            start = row + 1
            continue
        try:
            contents.append(read(path) if wanted else None)
        except OSError:
            contents.append(None)
        held += len(contents[-1] or b"")
    if contents:
        yield names.slice(start), pa.array(contents, pa.binary())


def with_content(documents: DataFrame, longest: int = LONGEST_VALUE) -> DataFrame:
    """A listing with a ``content`` column, read by path in the tasks.

    Null for folders, for missing and unreadable files, and for files of more than
    ``longest`` bytes, by default what a column can hold; a plug-in opens those by their path.
    Files are handed over ``FLUSH_BYTES`` at a time, larger ones on their own, without being
    held by Python.
    """
    ship_package(documents.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, contents in with_contents(batch, longest):
                yield pa.RecordBatch.from_arrays([*some.columns, contents], [*some.schema.names, "content"])

    names = [f.name for f in LISTING_SCHEMA]
    return documents.select(*names).mapInArrow(read, _CONTENT)


def dealt(listing: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """A listing, dealt out by size over ``num_partitions`` tasks, by default one per core."""
    return deal_by_size(listing, num_partitions or listing.sparkSession.sparkContext.defaultParallelism)


def opened(listing: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """A listing with a ``content`` column, its names dealt out over the tasks by size first."""
    return with_content(dealt(listing, num_partitions))


def read_content(
    spark: SparkSession,
    path: str,
    pattern: str = "*.pdf",
    recursive: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """The listing of a folder with a ``content`` column.

    The names are dealt out to ``num_partitions`` tasks by size before the files are
    opened; by default to one task per core. The bytes of documents are never shuffled.
    """
    return opened(list_documents(spark, path, pattern, recursive), num_partitions)
