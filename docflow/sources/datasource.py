"""``format("documents")``: documents as a batch source with pushed filters, and as a stream.

The batch reader opens what a written listing names. Filters on names, sizes and times
are applied to the names first, and contents are read only if the schema has them.

The stream reader lists the whole folder for each batch, hidden and empty files too. The
names that are new go to a log, one file per batch, whose numbers are the offsets: a
batch that runs again, also after a restart, has the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

from docflow.schemas import DATED_LISTING_SCHEMA
from docflow.session import scratch_dir, ship_package
from docflow.sources.content import with_contents
from docflow.sources.dealing import deal_by_size
from docflow.sources.filesystem import make_folder, names_in, open_input, open_output, read_file, rename
from docflow.sources.listing import compiled, folder_rows, full_path, list_documents, real_path

#: Names that a task reads at a time.
NAMES = 4096
#: Bytes of the files of one task of a stream.
TASK_BYTES = 256 << 20
DOCUMENT_SCHEMA = T.StructType([*DATED_LISTING_SCHEMA.fields, T.StructField("content", T.BinaryType(), True)])
_LISTING = pa.schema([
    ("document_path", pa.string()), ("file_name", pa.string()), ("file_size", pa.int64()),
    ("is_file", pa.bool_()), ("exists", pa.bool_()), ("modified", pa.timestamp("us", tz="UTC")),
])
_COMPARISONS: dict[type, Callable] = {
    ds.EqualTo: pc.equal, ds.GreaterThan: pc.greater, ds.GreaterThanOrEqual: pc.greater_equal,
    ds.LessThan: pc.less, ds.LessThanOrEqual: pc.less_equal,
    ds.StringStartsWith: lambda c, v: pc.starts_with(c, v), ds.StringEndsWith: lambda c, v: pc.ends_with(c, v),
    ds.StringContains: lambda c, v: pc.match_substring(c, v),
}


def can_filter(given: ds.Filter) -> bool:
    """Whether a filter is one that names can be tested for."""
    if isinstance(given, ds.Not):
        return can_filter(given.child)
    known = (*_COMPARISONS, ds.EqualNullSafe, ds.In, ds.IsNull, ds.IsNotNull)
    return isinstance(given, known) and len(given.attribute) == 1 and given.attribute[0] in _LISTING.names


def passes(given: ds.Filter, names: pa.RecordBatch) -> pa.Array:
    """True, false or null per row, as SQL has it."""
    if isinstance(given, ds.Not):
        return pc.invert(passes(given.child, names))
    column = names.column(given.attribute[0])
    if isinstance(given, ds.IsNull):
        return pc.is_null(column)
    if isinstance(given, ds.IsNotNull):
        return pc.is_valid(column)
    if isinstance(given, ds.In):
        values = pa.array([v for v in given.value if v is not None], column.type)
        found = pc.is_in(column, value_set=values)
        # A null, or a list with one, leaves open what is not found.
        unknown = pc.or_(pc.is_null(column), pa.scalar(len(values) < len(given.value)))
        return pc.if_else(pc.and_(unknown, pc.invert(found)), pa.scalar(None, pa.bool_()), found)
    if isinstance(given, ds.EqualNullSafe):
        return pc.is_null(column) if given.value is None else pc.fill_null(pc.equal(column, pa.scalar(given.value, column.type)), False)
    if isinstance(given, (ds.StringStartsWith, ds.StringEndsWith, ds.StringContains)):
        return _COMPARISONS[type(given)](column, given.value)
    return _COMPARISONS[type(given)](column, pa.scalar(given.value, column.type))


def opened_rows(names: pa.RecordBatch, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The asked columns of some names, with their contents, some bytes at a time."""
    if "content" not in columns:
        yield names.select(columns)
        return
    for rows, contents in with_contents(names, read=read_file):
        yield pa.RecordBatch.from_arrays([contents if c == "content" else rows.column(c) for c in columns], columns)


@dataclass
class NamesPartition(ds.InputPartition):
    """Some rows of a file of names."""

    path: str
    start: int = 0
    count: int | None = None


def _names(part: NamesPartition) -> Iterator[pa.RecordBatch]:
    with open_input(part.path) as file:
        table = pq.read_table(file, columns=_LISTING.names).cast(_LISTING)
    yield from table.slice(part.start, part.count).to_batches(max_chunksize=NAMES)


class DocumentReader(ds.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.listing = options.get("listing")
        if not self.listing:
            raise ValueError("format('documents') reads a written listing: use read_documents")
        self.columns = schema.fieldNames()
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for given in filters:
            if can_filter(given):
                self.filters.append(given)
            else:
                yield given

    def partitions(self) -> list[NamesPartition]:
        return [NamesPartition(f"{self.listing}/{n}") for n in sorted(names_in(self.listing)) if n.endswith(".parquet")]

    def read(self, partition: NamesPartition) -> Iterator[pa.RecordBatch]:
        for names in _names(partition):
            for given in self.filters:
                names = names.filter(passes(given, names))
            yield from opened_rows(names, self.columns)


class DocumentStreamReader(ds.DataSourceStreamReader):
    """Offsets are numbers of batches in the log; 0 is before the first."""

    def __init__(self, schema: T.StructType, options: dict):
        self.columns = schema.fieldNames()
        self.root = full_path(options["path"])
        self.log = options["log"].rstrip("/")
        self.matches = compiled(options.get("pattern", "*.pdf")).match
        self.deep = options.get("recursive", "false").lower() == "true"
        self.seen: set[str] | None = None
        self.last = 0

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def _load(self) -> None:
        self.seen = set()
        make_folder(self.log)
        numbers = sorted(int(n[6:-8]) for n in names_in(self.log) if n.startswith("batch-") and n.endswith(".parquet"))
        for number in numbers:
            for names in _names(NamesPartition(self._batch(number))):
                self.seen.update(names.column("document_path").to_pylist())
        self.last = numbers[-1] if numbers else 0

    def _batch(self, number: int) -> str:
        return f"{self.log}/batch-{number}.parquet"

    def _listed(self) -> Iterator[tuple]:
        todo, visited = [self.root], {real_path(self.root)}
        while todo:
            # Folders before links to them, so that a folder is listed by its own path.
            rows = sorted((r for f in todo for r in folder_rows(f, self.matches, self.deep)), key=lambda r: (r[8], r[0]))
            todo = []
            for *row, matches, is_folder, _, real in rows:
                if matches:
                    yield tuple(row)
                if self.deep and is_folder and real not in visited:
                    visited.add(real)
                    todo.append(row[0])

    def latestOffset(self) -> dict:
        if self.seen is None:
            self._load()
        new = [row for row in self._listed() if row[0] not in self.seen]
        if new:
            table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*new, strict=True), _LISTING, strict=True)], schema=_LISTING)
            written = f"{self.log}/.{uuid.uuid4().hex}"
            with open_output(written) as file:
                pq.write_table(table, file)
            rename(written, self._batch(self.last + 1))
            self.last += 1
            self.seen.update(row[0] for row in new)
        return {"batch": self.last}

    def partitions(self, start: dict, end: dict) -> list[NamesPartition]:
        parts = []
        for number in range(start["batch"] + 1, end["batch"] + 1):
            path = self._batch(number)
            with open_input(path) as file:
                sizes = pq.read_table(file, columns=["file_size"]).column(0).to_pylist()
            first, held = 0, 0
            for i, size in enumerate(sizes):
                if i > first and (held + (size or 0) > TASK_BYTES or i - first >= NAMES):
                    parts.append(NamesPartition(path, first, i - first))
                    first, held = i, 0
                held += size or 0
            parts.append(NamesPartition(path, first, len(sizes) - first))
        return parts

    def read(self, partition: NamesPartition) -> Iterator[pa.RecordBatch]:
        for names in _names(partition):
            yield from opened_rows(names, self.columns)


class DocumentSource(ds.DataSource):
    """The source behind ``format("documents")``."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self) -> T.StructType:
        return DOCUMENT_SCHEMA

    def reader(self, schema: T.StructType) -> DocumentReader:
        return DocumentReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> DocumentStreamReader:
        return DocumentStreamReader(schema, self.options)


def _registered(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(DocumentSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_documents(
    spark: SparkSession,
    path: str,
    pattern: str = "*",
    recursive: bool = True,
    content: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """The documents of a folder through ``format("documents")``, listed once.

    The listing is made in tasks, dealt out by size and written. Of the files, only those
    are opened whose names, sizes and times pass the filters on the result; without
    ``content`` none is. Turns filter push-down to Python sources on for the session.
    """
    _registered(spark)
    listing = scratch_dir(spark, "documents")
    tasks = num_partitions or spark.sparkContext.defaultParallelism
    deal_by_size(list_documents(spark, path, pattern, recursive, dated=True), tasks).write.parquet(listing)
    schema = DOCUMENT_SCHEMA if content else DATED_LISTING_SCHEMA
    return spark.read.format("documents").schema(schema).option("listing", listing).load()


def stream_every_document(spark: SparkSession, path: str, log: str, pattern: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """Each document that arrives in a folder once, hidden and empty ones too, with its content.

    ``log`` is a folder of the stream's own that all executors reach, such as one below its
    checkpoint. The driver lists the folder for each batch and knows the paths of all
    documents so far, as Spark's file streams do.
    """
    _registered(spark)
    stream = spark.readStream.format("documents").schema(DOCUMENT_SCHEMA)
    return stream.option("log", log).option("pattern", pattern).option("recursive", str(recursive).lower()).load(path)
