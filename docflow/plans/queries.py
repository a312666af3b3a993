"""The queries by which the package is checked and measured.

Each takes a session and a folder of Parquet tables and reads whole tables.
"""

from __future__ import annotations

import os
import re
import signal
import time
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.config import ConvertConfig
from docflow.functions.html import html_to_markdown as markdown
from docflow.functions.metadata import build_metadata, stringify_metadata
from docflow.functions.metadata import file_metadata as file_entries
from docflow.functions.paths import file_name, suffix, url_path
from docflow.operators import results, structure
from docflow.operators.convert import Converted, decode_content
from docflow.operators.validate import Rule, ends_with, file_rules, has_suffix, not_empty, validate
from docflow.plans import convert as plans
from docflow.plans.job import run_job
from docflow.schemas import OUTPUT_SCHEMA
from docflow.session import scratch_dir, ship_package
from docflow.sinks import Manifest, write_jsonl
from docflow.sources import balance, checked_documents, deal_by_size, documents_from_table, read_content, read_documents
from docflow.sources import list_documents as listing
from docflow.sources.dealing import FILE_BYTES
from docflow.streaming import stream_documents as document_stream
from docflow.streaming import stream_every_document, stream_results

# Documents below this length make the example converters fail.
SHORT = 100
# Below this length the hanging one hangs: few documents, so that the limit can be seconds.
TINY = 30


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _dealt(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table dealt out over the cores; the tables of the checks have few splits."""
    return balance(_table(spark, folder, name), spark.sparkContext.defaultParallelism)


def _first_line(df: DataFrame) -> DataFrame:
    """Results without traceback, which names lines of code."""
    return df.withColumn("error_message", F.substring_index("error_message", "\n", 1))


# --- native conversion -------------------------------------------------------


def convert_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Complete pages only, so that some rows are failures."""
    return plans.convert_pages(_dealt(spark, folder, "pages"), complete_only=True)


def convert_all_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page, also one that was cut off."""
    return plans.convert_pages(_dealt(spark, folder, "pages"))


def html_to_markdown(spark: SparkSession, folder: str) -> DataFrame:
    pages = _dealt(spark, folder, "pages")
    return pages.select("page_id", markdown(F.col("html")).alias("content"))


def html_to_markdown_full(spark: SparkSession, folder: str) -> DataFrame:
    """With navigation and footer, and so with links."""
    config = ConvertConfig(drop_boilerplate=False)
    pages = _dealt(spark, folder, "pages")
    return pages.select("page_id", markdown(F.col("html"), config).alias("content"))


def _order_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page per order, with a table and two images, made from the order's columns."""
    cells = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    return _dealt(spark, folder, "orders").select(
        F.concat(F.lit("order/"), F.col("o_orderkey"), F.lit(".html")).alias("document_path"),
        F.concat(
            F.lit("<html><body><h2>Order "),
            F.col("o_orderkey").cast("string"),
            F.lit("</h2><img alt='x' src=\"data:image/png;base64,"),
            F.base64(F.encode(F.col("o_orderstatus"), "UTF-8")),
            F.lit('"><IMG SRC="https://img.example/'),
            F.col("o_orderkey").cast("string"),
            F.lit('.png"/><table class="t"><tr><th>Key</th><th>State | S</th><th><b>Priority</b></th></tr>'),
            F.lit("<tr>"),
            *[F.concat(F.lit("<td> "), F.col(c).cast("string"), F.lit("</td>\n")) for c in cells],
            F.lit("</tr></table><p>End &lt;here&gt;</p></body></html>"),
        ).alias("content"),
    )


def document_tables(spark: SparkSession, folder: str) -> DataFrame:
    return structure.document_tables(_order_pages(spark, folder))


def table_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of five kinds with cells over several rows and columns, made from orders.

    Spans from the key's digits: a head over two columns, cells down the side, cells that
    reach around each other, spans that are no numbers or go beyond the table, a row that
    cells from above fill.
    """
    key = F.col("o_orderkey")
    number, state = key.cast("string"), F.col("o_orderstatus")
    down, across = (key % 3 + 2).cast("string"), (key % 4 + 1).cast("string")

    def page(text: str) -> Column:
        parts = re.split(r"(\{\w+\})", text)
        known = {"{key}": number, "{state}": state, "{down}": down, "{across}": across}
        return F.concat(*[known.get(p, F.lit(p)) for p in parts if p])

    kinds = [
        "<table><tr><th colspan={across}>{key}</th><th rowspan='2'>S</th></tr><tr><td>{state}</td><td>x</td></tr></table>",
        '<table><tr><td rowspan="{down}">side</td><td>{key}</td></tr><tr><td>b</td></tr><tr><td>{state}</td><td>c</td></tr></table>',
        "<table><tr><td rowspan=3>a<td colspan=2>{key}<tr><td rowspan=2>c<td>{state}<tr><td>e</table>",
        "<TABLE><TR><TD ROWSPAN=0>{key}<TD COLSPAN=x>b<TD colspan='0'>c<TR><TD>{state}<TR><TD rowspan='9'>e</TABLE>",
        "<table><tr><td rowspan=2>{key}<td rowspan=2 title='>'>{state}<tr></tr><tr><td>next</table>",
    ]
    content = F.element_at(F.array(*map(page, kinds)), (key % 5 + 1).cast("int"))
    pages = _dealt(spark, folder, "orders").select(
        F.concat(F.lit("order/"), key, F.lit(".html")).alias("document_path"), content.alias("content")
    )
    return structure.document_tables(pages, spans=True)


def list_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered lists in lists, verbatim text and brackets in attributes, made from orders."""
    key, first = F.col("o_orderkey").cast("string"), (F.col("o_orderkey") % 100).cast("string")
    content = F.concat(
        F.lit('<p title="a > b">Order</p>\n<ol start='), first, F.lit("><li>"), key, F.lit("<ul class='x'>\n<li>"), F.col("o_orderstatus"),
        F.lit("</li>\n<li>"), F.col("o_orderpriority"), F.lit("<ol><li>x <li>y</ol></li></ul>\ntail</li>\n<li><p>last</p></ol><pre class=q>\n  "),
        key, F.lit("\t"), F.col("o_orderstatus"), F.lit("\n\n  <b>end</b></pre>"),
    )
    pages = _dealt(spark, folder, "orders").select("o_orderkey", content.alias("html"))
    return pages.select("o_orderkey", markdown(F.col("html")).alias("content"))


def table_markdown(spark: SparkSession, folder: str) -> DataFrame:
    pages = _order_pages(spark, folder)
    return pages.select("document_path", markdown(F.col("content")).alias("content"))


def image_modes(spark: SparkSession, folder: str) -> DataFrame:
    html = F.col("content")
    return _order_pages(spark, folder).select(
        "document_path",
        *[
            markdown(html, ConvertConfig(image_mode=mode, tables=False)).alias(mode)
            for mode in ("placeholder", "referenced")
        ],
    )


def page_charsets(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as bytes in five forms: marked UTF-8 and UTF-16, Windows-1252 declared or not, plain UTF-8."""
    html, kind = F.col("html"), F.col("page_id") % 5
    western = ~html.rlike("[^\\x00-\\xff]")
    charset = lambda new: F.regexp_replace(html, '<meta charset="utf-8">', new)
    marked = lambda mark, name: F.concat(F.unhex(F.lit(mark)), F.encode(html, name))
    content = (
        F.when(kind == 0, marked("EFBBBF", "UTF-8")).when(kind == 1, marked("FFFE", "UTF-16LE"))
        .when((kind == 2) & western, F.encode(charset('<meta http-equiv="x" content="text/html; charset=Windows-1252">'), "ISO-8859-1"))
        .when((kind == 3) & western, F.encode(charset(""), "ISO-8859-1")).otherwise(F.encode(html, "UTF-8"))
    )
    pages = _dealt(spark, folder, "pages").withColumn("bytes", content)
    converted = plans.convert_valid(decode_content(documents_from_table(pages, "url", "bytes")), [])
    return converted.select("document_path", "success", "content")


def page_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """What pages say about themselves, with a description, an address and a repeated name added."""
    added = F.concat(
        F.lit('<head><meta name="Description" content="Page '), F.col("page_id"), F.lit(' &amp; more > less"><META content=u'),
        F.col("page_id"), F.lit(" property='og:url'/><!-- <meta name=no content=no> --><meta name=description content=second>"),
    )
    pages = _dealt(spark, folder, "pages")
    pages = pages.withColumn("html", F.replace("html", F.lit("<head>"), F.when(F.col("page_id") % 2 == 0, added).otherwise("<head>")))
    converted = plans.convert_pages(pages, ConvertConfig(page_metadata=True))
    return converted.select("document_path", F.get_json_object("metadata", "$.document_metadata").alias("document_metadata"))


def document_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return structure.document_blocks(convert_pages(spark, folder))


# --- validation and metadata -------------------------------------------------


def _page_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents_from_table(_table(spark, folder, "pages"), "url", "html")


def validate_suffix(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate(_page_documents(spark, folder), [has_suffix(".html")])
    name = F.col("file_name")
    return checked.select("document_path", "file_name", suffix(name).alias("suffix"), "is_valid")


def validate_documents(spark: SparkSession, folder: str) -> DataFrame:
    rules = [has_suffix(".html"), not_empty(), ends_with("</html>")]
    checked = validate(_page_documents(spark, folder), rules)
    return checked.select("document_path", "is_valid", "failed_rule", "error_message")


def file_metadata(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    entries = file_entries(
        F.col("url"), F.octet_length("html").cast("long"), file_name(url_path(F.col("url")))
    )
    return pages.select(*[value.alias(key) for key, value in entries.items()])


def document_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Page count and score are null for part of the documents, as is the optional entry."""
    n = F.col("n_chars")
    path = F.concat("source", F.lit("/"), F.col("doc_id"), F.lit(".txt"))
    metadata = build_metadata(
        path,
        F.octet_length("text"),
        num_pages=F.when(n >= 1000, F.floor(n / 1000)),
        confidence=F.when(n < 1000, F.lit(0.5)).when(n < 5000, F.lit(0.75)),
        document_metadata=F.when(F.col("lang") != "en", F.concat(F.lit("lang="), F.col("lang"))),
    )
    documents = _table(spark, folder, "documents")
    return documents.select(path.alias("document_path"), F.to_json(metadata).alias("metadata"))


def metadata_stringify(spark: SparkSession, folder: str) -> DataFrame:
    values = {
        "lang": F.nullif(F.col("lang"), F.lit("en")),
        "n_chars": F.col("n_chars"),
        "long": F.when(F.col("n_chars") > 500, F.lit(True)),
    }
    # A map column, null for one language and with null values for others.
    given = F.when(
        F.col("lang") != "de",
        F.create_map(F.lit("source"), F.nullif(F.col("source"), F.lit("src0"))),
    )
    return _table(spark, folder, "documents").select(
        "doc_id",
        F.to_json(stringify_metadata(values)).alias("metadata"),
        F.to_json(stringify_metadata(given)).alias("given_metadata"),
    )


# --- reports -----------------------------------------------------------------


def _page_results(spark: SparkSession, folder: str) -> DataFrame:
    """Not balanced: where no text is read, there is nothing to spread."""
    return plans.convert_pages(_table(spark, folder, "pages"), complete_only=True)


def status_summary(spark: SparkSession, folder: str) -> DataFrame:
    return results.summarize(_page_results(spark, folder))


def failures_report(spark: SparkSession, folder: str) -> DataFrame:
    return results.failures_report(_page_results(spark, folder))


def successes(spark: SparkSession, folder: str) -> DataFrame:
    succeeded = results.successes(_page_results(spark, folder))
    return succeeded.select("document_path", "metadata")


def preview(spark: SparkSession, folder: str) -> DataFrame:
    return results.preview(_page_results(spark, folder))


# --- plug-in conversion --------------------------------------------------------


def length_converter() -> Callable:
    """Returns the length of the text and refuses short texts."""

    def convert(path, text):
        if len(text) < SHORT:
            raise ValueError(f"only {len(text)} characters")
        return Converted(str(len(text)), num_pages=1 + len(text) // 1000, confidence=0.5)

    return convert


def hanging_converter() -> Callable:
    """Never returns for texts of hardly any length."""

    def convert(path, text):
        while len(text) < TINY:
            time.sleep(1)
        return str(len(text))

    return convert


def crashing_converter() -> Callable:
    """Takes the whole process down for short texts."""

    def convert(path, text):
        if len(text) < SHORT:
            os.kill(os.getpid(), signal.SIGKILL)
        return str(len(text))

    return convert


def byte_count_converter() -> Callable:
    return lambda path, content: str(len(content))


def refusing_converter() -> Callable:
    """Refuses files of more than 10,000 bytes."""

    def convert(path, content):
        if len(content) > 10_000:
            raise ValueError(f"{len(content)} bytes")
        return str(len(content))

    return convert


def _text_results(
    spark: SparkSession, folder: str, converter: Callable, **options
) -> DataFrame:
    ship_package(spark)
    documents = _dealt(spark, folder, "documents").withColumn(
        "path", F.concat("source", F.lit("/"), F.col("doc_id"), F.lit(".txt"))
    )
    return plans.convert_valid(
        documents_from_table(documents, "path", "text"),
        [not_empty(), Rule("plain", F.col("content").isNotNull())],
        converter,
        ConvertConfig(**options),
    )


def convert_python(spark: SparkSession, folder: str) -> DataFrame:
    return _first_line(_text_results(spark, folder, length_converter))


def convert_timeout(spark: SparkSession, folder: str) -> DataFrame:
    return _first_line(_text_results(spark, folder, hanging_converter, timeout_s=3))


def convert_isolated(spark: SparkSession, folder: str) -> DataFrame:
    return _first_line(_text_results(spark, folder, crashing_converter, isolate=True))


# --- folders, files, streams ---------------------------------------------------


def _part_files(documents: DataFrame) -> DataFrame:
    """Names relative to the folder of tables: tables may be files or folders of parts."""
    return documents.filter("is_file AND NOT startswith(file_name, '_') AND NOT startswith(file_name, '.')")


def list_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All part files of the tables; each table is a file or a folder."""
    return _part_files(listing(spark, folder, "*.parquet", recursive=True)).select("file_name", "file_size")


def tree_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' ids as files in a tree of three levels, listed level by level."""
    root = scratch_dir(spark, "tree")
    shelf = F.concat(F.lit("shelf"), F.col("doc_id") % 5)
    documents = _table(spark, folder, "documents").select(
        F.coalesce("lang", F.lit("none")).alias("lang"), F.coalesce("source", F.lit("none")).alias("source"), shelf.alias("shelf"),
        F.col("doc_id").cast("string").alias("value"),
    )
    documents.write.partitionBy("lang", "source", "shelf").text(root)
    part = lambda name: F.regexp_extract("document_path", f"/{name}=([^/]*)/", 1).alias(name)
    found = listing(spark, root, "*.txt", recursive=True)
    return found.groupBy(part("lang"), part("source"), part("shelf")).agg(F.sum("file_size").alias("bytes"))


def read_file_content(spark: SparkSession, folder: str) -> DataFrame:
    return _part_files(read_content(spark, folder, "*.parquet", recursive=True)).select(
        "file_name", "file_size", F.octet_length("content").cast("long").alias("content_bytes")
    )


def check_paths(spark: SparkSession, folder: str) -> DataFrame:
    """A table of paths, a third of them files, a third folders, a third missing."""
    n = F.col("doc_id") % 3
    path = F.when(n == 0, F.lit(f"{folder}/region.parquet")).when(n == 1, F.lit(f"{folder}/.")).otherwise(
        F.concat(F.lit(f"{folder}/missing-"), F.col("doc_id"), F.lit(".parquet"))
    )
    paths = _table(spark, folder, "documents").select("doc_id", path.alias("document_path"))
    checked = validate(checked_documents(paths), file_rules(".parquet"))
    return checked.groupBy("exists", "failed_rule").agg(F.count("*").alias("documents"), F.countDistinct("document_path").alias("paths"))


def documents_source(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' ids as files in a tree, of which a source with pushed filters opens some."""
    root = scratch_dir(spark, "tree")
    shelf = F.concat(F.lit("shelf"), F.col("doc_id") % 5)
    documents = _table(spark, folder, "documents").select(shelf.alias("shelf"), F.col("doc_id").cast("string").alias("value"))
    documents.write.partitionBy("shelf").text(root)
    found = read_documents(spark, root).where("file_name LIKE '%.txt' AND document_path LIKE '%/shelf=shelf3/%' AND file_size > 0")
    ids = F.explode(F.split(F.btrim(F.col("content").cast("string"), F.lit("\n")), "\n"))
    return found.select(ids.alias("id")).select(F.col("id").cast("long").alias("doc_id"))


def stream_every_file(spark: SparkSession, folder: str) -> DataFrame:
    """A stream over files of the documents' ids, with the empty mark of the writer, run twice."""
    ship_package(spark)
    work = scratch_dir(spark, "stream")
    source = F.coalesce("source", F.lit("none")).alias("source")
    documents = _table(spark, folder, "documents").select(source, F.col("doc_id").cast("string").alias("value"))
    documents.write.partitionBy("source").text(f"{work}/in")

    def convert(arrived: DataFrame) -> DataFrame:
        return plans.convert_valid(arrived, [not_empty()], byte_count_converter)

    for _ in range(2):
        files = stream_every_document(spark, f"{work}/in", f"{work}/log", "{*.txt,_SUCCESS}", recursive=True)
        stream_results(files, f"{work}/out", f"{work}/checkpoint", convert).awaitTermination()
    converted = spark.read.schema(OUTPUT_SCHEMA).json(f"{work}/out")
    kind = F.coalesce(F.nullif(F.regexp_extract("document_path", "/source=([^/]*)/", 1), F.lit("")), file_name(F.col("document_path")))
    return converted.groupBy(kind.alias("kind")).agg(
        F.sum(F.col("content").try_cast("long")).alias("bytes"), F.bool_and("success").alias("success")
    )


def convert_directory(spark: SparkSession, folder: str) -> DataFrame:
    """The whole batch job over the folder of tables: list, convert, write, read back."""
    ship_package(spark)
    output = scratch_dir(spark, "results")
    run_job(
        spark,
        folder,
        output,
        byte_count_converter,
        pattern="*.parquet",
        extensions=(".parquet",),
        recursive=True,
    )
    converted = spark.read.schema(OUTPUT_SCHEMA).json(output).select(
        file_name(F.col("document_path")).alias("file_name"), "success", "content", "error_message"
    )
    return converted.filter("success")


def job_failures(spark: SparkSession, folder: str) -> DataFrame:
    """The job's report on failures: files that the converter refuses."""
    ship_package(spark)
    report = run_job(
        spark,
        folder,
        scratch_dir(spark, "results"),
        refusing_converter,
        pattern="*.parquet",
        extensions=(".parquet",),
        recursive=True,
    )
    name = file_name(F.col("document_path"))
    return _first_line(report.failures).filter(F.col("error_message") != "Invalid file").select(
        name.alias("file_name"), F.regexp_extract("error_message", ": ([^:]*)$", 1).alias("reason")
    )


def job_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """A job that is broken off after its first chunk and goes on: each file is done once."""
    ship_package(spark)
    output = scratch_dir(spark, "resumed")
    for most in (1, None):
        run_job(
            spark, folder, output, byte_count_converter, pattern="*.parquet", extensions=(".parquet",), recursive=True,
            resume=True, chunk_bytes=1 << 18, max_chunks=most,
        )
    manifest = Manifest(spark, output)
    times = manifest.documents().groupBy("document_path").agg(F.count("*").alias("times"))
    converted = manifest.results().filter("success").join(times, "document_path")
    return converted.select(file_name(F.col("document_path")).alias("file_name"), "content", "times")


def jsonl_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Results that a failing job tries to replace: the old ones stay."""
    output = scratch_dir(spark, "jsonl")
    results_ = convert_pages(spark, folder)
    write_jsonl(results_, output)
    broken = results_.withColumn("content", F.when(F.col("success"), F.raise_error(F.lit("broken off"))).otherwise(F.col("content")))
    try:
        write_jsonl(broken, output)
    except PySparkException as error:
        if "broken off" not in str(error):
            raise
    return spark.read.schema(OUTPUT_SCHEMA).json(output)


def dealing_by_size(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of their length, dealt out to 16 tasks: how far the largest task exceeds what it may."""
    documents = _table(spark, folder, "documents")
    path = F.concat("source", F.lit("/"), F.col("doc_id"), F.lit(".txt"))
    listing_ = documents_from_table(documents.withColumn("path", path), "path", size=F.octet_length("text"))
    dealt = deal_by_size(listing_, 16).select("file_size", F.spark_partition_id().alias("task"))
    cost = F.coalesce("file_size", F.lit(0)) + F.lit(FILE_BYTES)
    loads = dealt.groupBy("task").agg(F.sum(cost).alias("load"), F.sum("file_size").alias("bytes"), F.count("*").alias("n"), F.max(cost).alias("most"))
    share = F.sum("load") / F.lit(16)
    return loads.agg(
        F.sum("n").alias("documents"), F.sum("bytes").alias("bytes"),
        (F.max("load") <= F.greatest(share * 1.25 + F.lit(FILE_BYTES), F.max("most"))).alias("even"),
    )


def preview_uncut(spark: SparkSession, folder: str) -> DataFrame:
    return results.preview(_page_results(spark, folder), n=40, width=None)


def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    output = scratch_dir(spark, "jsonl")
    write_jsonl(convert_pages(spark, folder), output)
    return spark.read.schema(OUTPUT_SCHEMA).json(output)


def stream_convert(spark: SparkSession, folder: str) -> DataFrame:
    """The table of pages as a stream of arriving Parquet files.

    It is a file or a folder of parts: a stream takes either if its path is a pattern.
    """
    work = scratch_dir(spark, "stream")
    pages = spark.readStream.schema(_table(spark, folder, "pages").schema).parquet(f"{folder}/pages.parque[t]")

    def convert(arrived: DataFrame) -> DataFrame:
        return plans.convert_pages(arrived, complete_only=True)

    stream_results(pages, f"{work}/out", f"{work}/checkpoint", convert).awaitTermination()
    return spark.read.schema(OUTPUT_SCHEMA).json(f"{work}/out")


def stream_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The files of the pages as a stream, through a plug-in."""
    ship_package(spark)
    work = scratch_dir(spark, "stream")

    def convert(documents: DataFrame) -> DataFrame:
        return plans.convert_valid(
            documents, [has_suffix(".parquet"), not_empty()], byte_count_converter
        )

    files = document_stream(spark, f"{folder}/pages.parque[t]", "*.parquet")
    stream_results(files, f"{work}/out", f"{work}/checkpoint", convert).awaitTermination()
    return spark.read.schema(OUTPUT_SCHEMA).json(f"{work}/out").select(
        file_name(F.col("document_path")).alias("file_name"), "success", "content"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "convert_pages": convert_pages,
    "convert_all_pages": convert_all_pages,
    "html_to_markdown": html_to_markdown,
    "html_to_markdown_full": html_to_markdown_full,
    "table_markdown": table_markdown,
    "list_markdown": list_markdown,
    "image_modes": image_modes,
    "page_charsets": page_charsets,
    "page_metadata": page_metadata,
    "document_blocks": document_blocks,
    "document_tables": document_tables,
    "table_spans": table_spans,
    "validate_suffix": validate_suffix,
    "validate_documents": validate_documents,
    "file_metadata": file_metadata,
    "document_metadata": document_metadata,
    "metadata_stringify": metadata_stringify,
    "status_summary": status_summary,
    "failures_report": failures_report,
    "successes": successes,
    "preview": preview,
    "preview_uncut": preview_uncut,
    "convert_python": convert_python,
    "convert_timeout": convert_timeout,
    "convert_isolated": convert_isolated,
    "list_documents": list_documents,
    "tree_listing": tree_listing,
    "read_content": read_file_content,
    "check_paths": check_paths,
    "documents_source": documents_source,
    "convert_directory": convert_directory,
    "job_failures": job_failures,
    "job_resumed": job_resumed,
    "dealing_by_size": dealing_by_size,
    "jsonl_roundtrip": jsonl_roundtrip,
    "jsonl_overwrite": jsonl_overwrite,
    "stream_convert": stream_convert,
    "stream_documents": stream_documents,
    "stream_every_file": stream_every_file,
}
