"""Working with results: flat form, failures, counts, preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_results(df: DataFrame) -> DataFrame:
    """The five output columns; the metadata map becomes JSON text."""
    # Names and order of the columns.
    return df.select(
        "document_path",
        F.col("result.success").alias("success"),
        F.col("result.content").alias("content"),
        F.to_json("result.metadata").alias("metadata"),
        F.col("result.error_message").alias("error_message"),
    )


def failures(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("success"))


def successes(df: DataFrame) -> DataFrame:
    return df.filter(F.col("success"))


def failures_report(df: DataFrame) -> DataFrame:
    """Path and full error of every document that failed."""
    return failures(df).select("document_path", "error_message")


def status_counts() -> list[Column]:
    """The three counts as aggregates, for ``agg`` or for ``observe``."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("success")).alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
    ]


def summarize(df: DataFrame) -> DataFrame:
    """One row ``total, succeeded, failed``, in one pass."""
    return df.agg(*status_counts())


def preview(df: DataFrame, n: int = 20, width: int | None = 50) -> DataFrame:
    """The first ``n`` rows by path, as text; cells longer than ``width`` are cut.

    The n-th smallest path is found first, from the paths alone: each task keeps
    ``n`` of them. As a filter it moves below the conversion, to the scan, so only
    what is shown is converted, and nothing is sorted as a whole.
    """

    def cell(field: T.StructField) -> Column:
        text = F.col(field.name).cast("string")
        if width is not None:
            short = F.concat(F.left(text, F.lit(width - 3)), F.lit("..."))
            text = F.when(F.length(text) > width, short).otherwise(text)
        return text.alias(field.name)

    path = F.col("document_path")
    last = df.select(path).orderBy(path).limit(n).agg(F.max(path)).scalar()
    shown = df.filter(path.isNull() | (path <= last))
    return shown.orderBy("document_path").limit(n).select(*[cell(f) for f in df.schema.fields])
