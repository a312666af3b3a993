"""Conversion: documents in, one result per document out.

Two ways lead to the same ``result`` column. ``convert_html`` is an expression
and never leaves the JVM. ``convert_documents`` hands each document to a plug-in,
for formats that only a library can read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.config import ConvertConfig
from docflow.functions.charsets import decoded
from docflow.functions.html import html_to_markdown
from docflow.functions.metadata import build_metadata, empty_metadata
from docflow.functions.pages import page_metadata
from docflow.operators.isolation import failure_text, worker_converter
from docflow.sources.content import LONGEST_VALUE
from docflow.sources.filesystem import Unread

# Bytes of converted text a task collects before it hands them to Spark.
FLUSH_BYTES = 16 << 20


class Converted(NamedTuple):
    """What a converter returns when it knows more than the text.

    ``confidence`` is a number. ``document_metadata`` is kept as its ``str``.
    """

    content: str
    num_pages: Any = 0
    confidence: Any = 0.0
    document_metadata: Any = None


Converter = Callable[[str, Any], "str | Converted"]


def result_struct(
    success: Column, content: Column, metadata: Column, error: Column, path: Column
) -> Column:
    """The result envelope; the one place that decides how a failure looks."""
    ok = F.coalesce(success, F.lit(False))
    return F.struct(
        ok.alias("success"),
        F.when(ok, content).otherwise("").alias("content"),
        F.when(ok, metadata).otherwise(empty_metadata()).alias("metadata"),
        F.when(~ok, error).alias("error_message"),
        path.alias("file_path"),
    )


def convert_html(df: DataFrame, config: ConvertConfig | None = None) -> DataFrame:
    """Add ``result`` to validated HTML documents.

    The text is computed for valid rows only, and by Spark only where a later
    step reads it: counting or listing failures converts nothing.
    """
    path, text = F.col("document_path"), F.make_valid_utf8(F.col("content").cast("string"))
    text = F.regexp_replace(text, "^\ufeff", "")  # a byte-order mark
    about = F.to_json(page_metadata(text)) if config and config.page_metadata else None
    return df.withColumn(
        "result",
        result_struct(
            F.col("is_valid"),
            F.when(F.col("is_valid"), html_to_markdown(text, config)),
            build_metadata(path, F.col("file_size"), F.col("file_name"), document_metadata=about),
            F.col("error_message"),
            path,
        ),
    )


def decode_content(df: DataFrame) -> DataFrame:
    """The bytes in ``content`` as text, by each page's own character set.

    ``functions.charsets`` says how it is found. Null stays null; other columns stay as
    they are, and so does their order.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([None if b is None else decoded(b) for b in batch.column("content").to_pylist()], pa.string())
            yield batch.set_column(batch.schema.get_field_index("content"), "content", texts)

    fields = [T.StructField(f.name, T.StringType() if f.name == "content" else f.dataType) for f in df.schema]
    return df.withColumn("content", F.col("content").cast("binary")).mapInArrow(decode, T.StructType(fields))


def _clean(text: str) -> str:
    """Text that can be stored: halves of surrogate pairs are written out."""
    return text.encode("utf-8", "backslashreplace").decode("utf-8")


def _fields(path: str, result: Any, error: str | None) -> tuple:
    """(success, content, num_pages, confidence, document_metadata, error)."""
    if error is None:
        try:
            if isinstance(result, str):
                result = Converted(result)
            if not isinstance(result, Converted) or not isinstance(result.content, str):
                raise TypeError(f"converter returned {type(result).__name__}, not text")
            pages, score = result.num_pages, result.confidence
            extra = result.document_metadata
            return (
                True,
                _clean(result.content),
                "" if pages is None else _clean(str(pages)),
                "" if score is None else _clean(str(score)),
                None if extra is None else _clean(str(extra)),
                None,
            )
        except Exception as bad:
            error = failure_text(path, str(bad))
    return False, "", None, None, None, _clean(error)


_CONVERTED = T.StructType([
    T.StructField("document_path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("content", T.StringType()),
    T.StructField("num_pages", T.StringType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("document_metadata", T.StringType()),
    T.StructField("error_message", T.StringType()),
])
_ARROW = pa.schema([
    ("document_path", pa.string()),
    ("file_name", pa.string()),
    ("file_size", pa.int64()),
    ("success", pa.bool_()),
    ("content", pa.string()),
    ("num_pages", pa.string()),
    ("confidence", pa.string()),
    ("document_metadata", pa.string()),
    ("error_message", pa.string()),
])


def _task(factory: Callable[[], Converter], config: ConvertConfig, opens: bool) -> Callable:
    """The function one task runs, with the converter of its Python worker.

    With ``opens`` the column of contents holds the paths of files to be read.
    """
    pickled = cloudpickle.dumps(factory)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = worker_converter(pickled, config)
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
            return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        def add(name: str, length: int, path: str, fields: tuple) -> None:
            nonlocal size
            rows.append((path, name, length, *fields))
            size += sum(len(text.encode()) for text in fields if isinstance(text, str))

        def full(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal rows, size
            if rows and size >= least:
                yield flush()
                rows, size = [], 0

        try:
            for batch in batches:
                for row in range(batch.num_rows):
                    path, name, length, valid, error, content = (c[row].as_py() for c in batch.columns)
                    if not valid:
                        add(name, length, path, (False, "", None, None, None, error))
                        yield from full(FLUSH_BYTES)
                        continue
                    if opens and content is not None:
                        content = Unread(content, length or 0)
                    for tag, result, failure in convert.begin((name, length, path), path, content):
                        add(*tag, _fields(tag[-1], result, failure))
                        yield from full(FLUSH_BYTES)
                yield from full(0)
            for tag, result, failure in convert.rest():
                add(*tag, _fields(tag[-1], result, failure))
                yield from full(FLUSH_BYTES)
            yield from full(0)
        finally:
            convert.drop()

    return run


def convert_documents(
    df: DataFrame,
    converter: Callable[[], Converter],
    config: ConvertConfig | None = None,
    num_partitions: int | None = None,
    opens: bool = False,
) -> DataFrame:
    """Convert validated documents with a plug-in; one ``result`` per input row.

    ``converter`` takes no argument and returns a function of path and content
    (bytes, text, or null when the document is to be opened by its path) that
    returns a ``str`` or a ``Converted``. It is built once per Python worker of an
    executor and serves all tasks of the worker. Whatever it does to one document -
    raise, run over time or, with ``isolate``, crash the process - ends up in that
    document's row. A converter that cannot be built fails the task, which Spark then
    tries elsewhere.

    The rows pass through one Arrow operator, which Spark never evaluates twice;
    the bytes of invalid documents are not sent to it. ``num_partitions`` deals
    the rows out anew; by default they stay in the splits of the scan.

    With ``opens`` the documents are the files of a listing: those that are valid are read
    one at a time, in the process that converts them, and Spark moves no bytes. What can't
    be read, or is longer than a value can be, is null to the converter.
    """
    config = config or ConvertConfig()
    if opens:
        short = F.col("is_file") & (F.coalesce("file_size", F.lit(0)) <= F.lit(LONGEST_VALUE))
        content = F.when(short, F.col("document_path"))
    else:
        content = F.col("content") if "content" in df.columns else F.lit(None).cast("string")
    documents = df.select(
        "document_path",
        "file_name",
        "file_size",
        "is_valid",
        "error_message",
        F.when(F.col("is_valid"), content).alias("content"),
    )
    if num_partitions is not None:
        documents = documents.repartition(num_partitions)
    converted = documents.mapInArrow(_task(converter, config, opens), _CONVERTED)
    path = F.col("document_path")
    return converted.select(
        "document_path",
        result_struct(
            F.col("success"),
            F.col("content"),
            build_metadata(
                path,
                F.col("file_size"),
                F.col("file_name"),
                F.col("num_pages"),
                F.col("confidence"),
                F.col("document_metadata"),
            ),
            F.col("error_message"),
            path,
        ).alias("result"),
    )
