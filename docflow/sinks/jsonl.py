"""JSON lines in shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.sinks.publish import replace_folder

STATUS = "status"


def write_jsonl(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write rows as JSON lines, with null fields and without escaping non-ASCII text.

    ``path`` becomes a folder of part files, written by all tasks at once. It replaces
    what was there, but only when it is whole: a job that fails leaves the old result.
    """
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    replace_folder(df.sparkSession, path, writer.json)


def with_status(df: DataFrame) -> DataFrame:
    return df.withColumn(STATUS, F.when(F.col("success"), "succeeded").otherwise("failed"))


def write_results(df: DataFrame, path: str) -> None:
    """Write flat results as JSON lines.

    Succeeded and failed documents lie in folders of their own, so that a report on
    failures reads no converted text. Every line still holds all five fields.
    """
    write_jsonl(with_status(df), path, partition_by=STATUS)


def write_chunk(df: DataFrame, path: str) -> None:
    """Flat results of one chunk into a new folder, in the layout of ``write_results``."""
    with_status(df).write.option("ignoreNullFields", "false").partitionBy(STATUS).json(path)
