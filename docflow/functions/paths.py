"""File names and suffixes of paths and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_path(url: Column) -> Column:
    """A web address without its query and its fragment; any other path as it is.

    In paths of files and objects ``?`` and ``#`` are characters like others.
    """
    return F.when(url.rlike("(?i)^https?://"), F.regexp_replace(url, r"(?s)[?#].*\z", "")).otherwise(url)


def file_name(path: Column) -> Column:
    """Last part of a path; slashes at its end do not count."""
    return F.regexp_extract(path, r"([^/]*)/*\z", 1)


def suffix(name: Column) -> Column:
    """Last dot and what follows, or ``''``.

    A leading dot alone does not start a suffix (``.pdf`` has none), and neither
    does a dot at the end (``a.`` has none).
    """
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]+)\z", 1)
