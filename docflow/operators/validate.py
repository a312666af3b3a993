"""Validation: which documents may be converted at all."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.paths import suffix

# Fixed value: the error text of every document that fails validation.
INVALID_FILE = "Invalid file"


class Rule(NamedTuple):
    """A named condition a document must meet; null counts as not met."""

    name: str
    holds: Column


def exists() -> Rule:
    return Rule("exists", F.col("exists"))


def is_file() -> Rule:
    return Rule("is_file", F.col("is_file"))


def has_suffix(*extensions: str) -> Rule:
    """The suffix of the file name, in lower case, is one of these."""
    return Rule("suffix", F.lower(suffix(F.col("file_name"))).isin(*extensions))


def not_empty() -> Rule:
    return Rule("empty", F.col("file_size") > 0)


def ends_with(tail: str) -> Rule:
    """The text ends with ``tail`` in either case; white space and comments may follow."""
    # Atomic groups: only what follows the last occurrence is looked at, and once.
    end = rf"(?is)\A(?>.*{re.escape(tail)})(?:\s++|<!--(?>.*?-->))*+\z"
    return Rule("truncated", F.col("content").cast("string").rlike(end))


def file_rules(*extensions: str) -> list[Rule]:
    """The rules for files: there, a file, of one of these types."""
    return [exists(), is_file(), has_suffix(*(extensions or (".pdf",)))]


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``is_valid``, ``failed_rule`` (the first one not met) and ``error_message``."""
    failed = F.coalesce(
        *[F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.name)) for rule in rules],
        F.lit(None).cast("string"),
    )
    return (
        df.withColumn("failed_rule", failed)
        .withColumn("is_valid", F.col("failed_rule").isNull())
        .withColumn("error_message", F.when(~F.col("is_valid"), F.lit(INVALID_FILE)))
    )
