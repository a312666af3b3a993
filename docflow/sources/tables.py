"""Documents held in tables, and how many tasks a conversion should use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.paths import file_name, url_path


def documents_from_table(
    df: DataFrame, path_col: str, content_col: str | None = None, size: Column | None = None
) -> DataFrame:
    """A table of documents in the form of a listing, with content if it has any.

    ``size`` defaults to the bytes of the content. Without ``content_col`` a plug-in
    opens each document by its path, in its task, so a work list of any length stays
    a table.
    """
    path = F.col(path_col)
    if size is None:
        size = F.lit(None) if content_col is None else F.octet_length(content_col)
    documents = [
        path.alias("document_path"),
        file_name(url_path(path)).alias("file_name"),
        size.cast("long").alias("file_size"),
        F.lit(True).alias("is_file"),
        F.lit(True).alias("exists"),
    ]
    if content_col is not None:
        documents.append(F.col(content_col).alias("content"))
    return df.select(*documents)


def balance(df: DataFrame, num_partitions: int) -> DataFrame:
    """Deal documents out evenly over tasks before a costly conversion.

    For inputs with fewer splits than the cluster has cores, such as a file with one row
    group; it shuffles every document's bytes, so larger inputs are better left alone.
    Rows are dealt out in turn: no key that many documents share makes one task large.
    """
    return df.repartition(num_partitions)
