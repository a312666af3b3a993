"""The metadata map of a document."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions.paths import file_name, suffix


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def empty_metadata() -> Column:
    """A map without entries; failure rows carry it instead of null."""
    return F.expr("cast(map() AS map<string,string>)")


def stringify_metadata(values: Mapping[str, Column] | Column) -> Column:
    """A ``map<string,string>`` without nulls.

    Takes either named columns of any scalar type, whose order becomes the key
    order, or a map column. A null value becomes ``''`` and a null map ``{}``.
    """
    if isinstance(values, Column):
        texts = F.transform_values(values, lambda _, v: _text(v))
        return F.coalesce(texts.cast("map<string,string>"), empty_metadata())
    if not values:
        return empty_metadata()
    return F.create_map(*[part for key, v in values.items() for part in (F.lit(key), _text(v))])


def file_metadata(path: Column, size: Column, name: Column | None = None) -> dict[str, Column]:
    """The four entries known without opening the document, in output order."""
    # These keys and those of ``build_metadata``.
    name = file_name(path) if name is None else name
    return {
        "file_name": name,
        "file_size": size,
        "file_extension": suffix(name),
        "file_path": path,
    }


def build_metadata(
    path: Column,
    size: Column,
    name: Column | None = None,
    num_pages: Column | None = None,
    confidence: Column | None = None,
    document_metadata: Column | None = None,
) -> Column:
    """The whole metadata map.

    ``num_pages`` falls back to 0 and ``confidence`` to 0.0. The entry
    ``document_metadata`` is present only where its column is not null.
    """
    entries = file_metadata(path, size, name)
    # Text before the fallback: mixing a string with a number would parse the string.
    for key, value, fallback in (
        ("num_pages", num_pages, "0"),
        ("confidence_score", confidence, "0.0"),
    ):
        known = F.lit(None) if value is None else value
        entries[key] = F.coalesce(known.cast("string"), F.lit(fallback))
    metadata = stringify_metadata(entries)
    if document_metadata is None:
        return metadata
    extra = F.when(
        document_metadata.isNotNull(),
        F.create_map(F.lit("document_metadata"), _text(document_metadata)),
    ).otherwise(empty_metadata())
    return F.map_concat(metadata, extra)
