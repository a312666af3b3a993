"""Whole conversions, composed of sources and operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.config import ConvertConfig
from docflow.operators.convert import convert_documents, convert_html, decode_content
from docflow.operators.results import flatten_results
from docflow.operators.validate import Rule, ends_with, file_rules, validate
from docflow.session import ship_package
from docflow.sources.content import dealt, opened
from docflow.sources.listing import documents_from_paths, list_documents
from docflow.sources.tables import documents_from_table

# Types the built-in converter reads.
HTML_SUFFIXES = frozenset({".html", ".htm", ".xhtml"})


def convert_valid(
    documents: DataFrame,
    rules: list[Rule],
    converter: Callable | None = None,
    config: ConvertConfig | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Documents to flat results, with a plug-in or, without one, as HTML."""
    checked = validate(documents, rules)
    if converter is None:
        converted = convert_html(checked, config)
    else:
        converted = convert_documents(checked, converter, config, num_partitions)
    return flatten_results(converted)


def convert_pages(
    pages: DataFrame, config: ConvertConfig | None = None, complete_only: bool = False
) -> DataFrame:
    """A table of web pages (``url, html``) to flat results.

    A page that was cut off is converted as far as it goes, unless ``complete_only`` asks
    for pages that end with ``</html>``; others are then invalid.
    """
    documents = documents_from_table(pages, "url", "html")
    return convert_valid(documents, [ends_with("</html>")] if complete_only else [], config=config)


def convert_listing(
    listing: DataFrame,
    converter: Callable | None = None,
    config: ConvertConfig | None = None,
    extensions: tuple[str, ...] = (".pdf",),
    num_partitions: int | None = None,
) -> DataFrame:
    """Every row of a listing to one flat result; the files are opened in the tasks."""
    if converter is None and not HTML_SUFFIXES.issuperset(extensions):
        raise ValueError(f"files of type {', '.join(extensions)} need a converter")
    rules = file_rules(*extensions)
    if converter is None:
        rules.append(Rule("unreadable", F.col("content").isNotNull()))
        return convert_valid(decode_content(opened(listing, num_partitions)), rules, config=config)
    ship_package(listing.sparkSession)
    checked = validate(dealt(listing, num_partitions), rules)
    return flatten_results(convert_documents(checked, converter, config, opens=True))


def convert_directory(
    spark: SparkSession,
    path: str,
    converter: Callable | None = None,
    config: ConvertConfig | None = None,
    pattern: str = "*.pdf",
    extensions: tuple[str, ...] = (".pdf",),
    recursive: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """Every matching entry of a folder to one flat result.

    Files are opened in the tasks, hidden and empty ones, too. A plug-in gets the bytes,
    or null if they are too many for one value, and then opens the file by its path. The
    built-in converter gets the text, by each page's own character set.
    """
    return convert_listing(list_documents(spark, path, pattern, recursive), converter, config, extensions, num_partitions)


def convert_one(
    spark: SparkSession,
    path: str,
    converter: Callable,
    config: ConvertConfig | None = None,
    extensions: tuple[str, ...] = (".pdf",),
) -> DataFrame:
    """One document, which the converter opens by its path."""
    return convert_valid(documents_from_paths(spark, [path]), file_rules(*extensions), converter, config)
