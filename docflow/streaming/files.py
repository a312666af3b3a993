"""Documents that arrive over time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docflow.functions.paths import file_name
from docflow.schemas import BINARY_FILE_SCHEMA
from docflow.sources.content import with_content


def stream_documents(
    spark: SparkSession, path: str, pattern: str = "*.pdf", max_files_per_batch: int = 10_000
) -> DataFrame:
    """Each newly arrived file of a folder once, in the form of a listing with content.

    The stream brings the paths; the tasks open the files, so one that cannot be read
    is a row and does not end the stream. Like every file stream it never sees hidden,
    underscore or empty files; ``missing_documents`` finds those.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(path)
    )
    listed = files.select(
        F.col("path").alias("document_path"),
        file_name(F.col("path")).alias("file_name"),
        F.col("length").alias("file_size"),
        F.lit(True).alias("is_file"),
        F.lit(True).alias("exists"),
    )
    return with_content(listed)


def stream_results(
    documents: DataFrame, output: str, checkpoint: str, convert: Callable[[DataFrame], DataFrame]
) -> StreamingQuery:
    """Convert what has arrived since the last run, append it as JSON lines, then stop.

    ``convert`` maps documents to flat results, as for a batch. The checkpoint
    makes a rerun, also after a lost executor or driver, write each document once.
    """
    return (
        convert(documents)
        .writeStream.format("json")
        .option("ignoreNullFields", "false")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def missing_documents(listing: DataFrame, results: DataFrame) -> DataFrame:
    """Listed documents without a result, such as files the stream cannot see."""
    done = results.select("document_path").hint("merge")
    return listing.join(done, "document_path", "left_anti")
