"""What a page says about itself, as one native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions.html import QUOTED_GT, QUOTED_LT, attribute, bind, collapse_blanks, decode_entities, visible

# Private marks between name and value, and between entries.
_VALUE, _ENTRY = "\x02", "\x03"


def _in_head(html: Column) -> Column:
    return visible(F.element_at(F.split(html, r"(?i)<body(?=[\s>])", 2), 1))


def _title(head: Column) -> Column:
    """The text of the first ``<title>``; null without one."""
    after = F.get(F.split(head, r"(?i)<title(?=[\s>])", 2), F.lit(1))
    return F.nullif(F.trim(collapse_blanks(F.regexp_extract(after, r"(?is)\A[^>]*+>([^<]*+)</title", 1))), F.lit(""))


def _metas(head: Column) -> Column:
    """``name, value`` of each ``<meta>`` that has a name and a content, in their order."""

    def pair(piece: Column) -> Column:
        tag = F.concat(F.lit(" "), F.substring_index(piece, ">", 1))
        name = attribute(tag, "name")
        name = F.lower(F.trim(F.when(name == "", attribute(tag, "property")).otherwise(name)))
        return F.struct(name.alias("name"), F.trim(collapse_blanks(attribute(tag, "content"))).alias("value"))

    pieces = F.split(head, r"(?i)<meta(?=[\s/>])", -1)
    # What precedes the first tag has neither.
    named = F.transform(pieces, lambda piece, i: F.when(i > 0, pair(piece)))
    return F.filter(named, lambda m: (m["name"] != "") & (m["value"] != ""))


def _first_of_each(entries: Column) -> Column:
    """Entries by name, of a name that occurs several times the first."""
    placed = F.transform(entries, lambda e, i: F.struct(e["name"].alias("name"), i.alias("i"), e["value"].alias("value")))
    return bind(
        F.array_sort(placed),
        lambda sorted_: F.filter(sorted_, lambda e, i: (i == 0) | (e["name"] != F.get(sorted_, i - 1)["name"])),
    )


def page_metadata(html: Column) -> Column:
    """``title`` and the named ``<meta>`` contents of a page's head, as a map sorted by name.

    Names are in lower case; of a name the first content counts, and ``<title>`` before a
    ``<meta>`` of this name. Comments, scripts and the body are not looked at. Null where
    the page has none of them.
    """

    def found(head: Column) -> Column:
        title = F.struct(F.lit("title").alias("name"), _title(head).alias("value"))
        entries = _first_of_each(F.filter(F.concat(F.array(title), _metas(head)), lambda e: e["value"].isNotNull()))
        # Entities are decoded once for all; they can't become one of the marks.
        text = F.array_join(F.transform(entries, lambda e: F.concat(e["name"], F.lit(_VALUE), e["value"])), _ENTRY)
        text = F.translate(decode_entities(text), QUOTED_LT + QUOTED_GT, "<>")
        pair = lambda e: F.struct(F.substring_index(e, _VALUE, 1).alias("key"), F.substring_index(e, _VALUE, -1).alias("value"))
        return F.when(F.size(entries) > 0, F.map_from_entries(F.transform(F.split(text, _ENTRY), pair)))

    return bind(_in_head(html), found)
