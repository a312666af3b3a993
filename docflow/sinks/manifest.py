"""Results in chunks, with a manifest of the documents that are done.

Layout of a resumable output::

    chunk=<number>/status=succeeded|failed/part-*     results
    _manifest/chunk=<number>/counts                   total, succeeded, failed
    _manifest/chunk=<number>/documents                path, size and time of each document

A chunk is done when its documents are written, the last of its three parts. A run that
ends before that leaves a chunk without them; nobody reads it, and the next run removes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.results import status_counts
from docflow.schemas import OUTPUT_SCHEMA
from docflow.sinks.publish import path_exists, remove_path

#: What tells whether a document is the one that was converted.
IDENTITY = "document_path string, file_size long, modified timestamp"
COUNTS = "total long, succeeded long, failed long"


class Manifest:
    """The chunks of an output folder that are done."""

    def __init__(self, spark: SparkSession, output: str):
        self.spark, self.output = spark, output.rstrip("/")
        if path_exists(spark, self.output) and not path_exists(spark, f"{self.output}/_manifest"):
            raise ValueError(f"{output} holds results without a manifest; a run can't go on from them")

    def _chunk(self, number: int) -> str:
        return f"{self.output}/_manifest/chunk={number}"

    def chunks(self) -> list[int]:
        """The numbers of the chunks that are done, in the order in which they were made."""
        done, number = [], 0
        while path_exists(self.spark, f"{self._chunk(number)}/documents/_SUCCESS"):
            done.append(number)
            number += 1
        return done

    def documents(self) -> DataFrame:
        """``document_path, file_size, modified, chunk`` of all that is done; a changed document has several rows."""
        done = self.chunks()
        if not done:
            return self.spark.createDataFrame([], f"{IDENTITY}, chunk int")
        files = self.spark.read.schema(IDENTITY).parquet(*(f"{self._chunk(n)}/documents" for n in done))
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/chunk=(\d+)/documents/", 1).cast("int")
        return files.select("document_path", "file_size", "modified", number.alias("chunk"))

    def left(self, listing: DataFrame) -> DataFrame:
        """The listed documents that are not done, or have changed in size or time since."""
        done = self.documents().drop("chunk").distinct().toDF("_path", "_size", "_time")
        same = (
            listing["document_path"].eqNullSafe(F.col("_path")) & listing["file_size"].eqNullSafe(F.col("_size"))
            & listing["modified"].eqNullSafe(F.col("_time"))
        )
        return listing.join(done, same, "left_anti")

    def start(self, number: int) -> str:
        """The folder of a new chunk's results, without what an earlier attempt has left."""
        path = f"{self.output}/chunk={number}"
        remove_path(self.spark, path)
        remove_path(self.spark, self._chunk(number))
        return path

    def finish(self, number: int, documents: DataFrame, counts: dict) -> None:
        row = tuple(counts[c] for c in ("total", "succeeded", "failed"))
        self.spark.createDataFrame([row], COUNTS).coalesce(1).write.json(f"{self._chunk(number)}/counts")
        documents.select("document_path", "file_size", "modified").write.parquet(f"{self._chunk(number)}/documents")

    def results(self, status: str | None = None) -> DataFrame:
        """The flat results of all chunks that are done, of a changed document the last one.

        With ``status``, ``succeeded`` or ``failed``, only those files are read.
        """
        paths = [f"{self.output}/chunk={n}" + (f"/status={status}" if status else "") for n in self.chunks()]
        paths = [p for p in paths if not status or path_exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], OUTPUT_SCHEMA)
        rows = self.spark.read.schema(OUTPUT_SCHEMA).option("recursiveFileLookup", "true").json(paths)
        documents = self.documents()
        last = documents.groupBy("document_path").agg(F.max("chunk").alias("last"), F.min("chunk").alias("first")).where("first < last")
        if last.isEmpty():
            return rows
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/chunk=(\d+)/status=", 1).cast("int")
        numbered = rows.select("*", number.alias("_chunk"))
        old = documents.join(last.select("document_path", "last"), "document_path").where("chunk < last")
        old = old.select(F.col("document_path").alias("_path"), F.col("chunk").alias("_old"))
        replaced = numbered["document_path"].eqNullSafe(old["_path"]) & (numbered["_chunk"] == old["_old"])
        return numbered.join(old, replaced, "left_anti").drop("_chunk")

    def counts(self) -> dict:
        """``total, succeeded, failed`` over the results of all runs."""
        done = self.chunks()
        if not done:
            return dict.fromkeys(("total", "succeeded", "failed"), 0)
        counted = self.spark.read.schema(COUNTS).json([f"{self._chunk(n)}/counts" for n in done])
        sums = counted.agg(*(F.sum(c).alias(c) for c in counted.columns)).first().asDict()
        if self.documents().groupBy("document_path").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return sums
        # Results that were replaced don't count.
        return self.results().agg(*status_counts()).first().asDict()


def read_results(spark: SparkSession, output: str) -> DataFrame:
    """The flat results of a job, resumable or not."""
    if path_exists(spark, f"{output.rstrip('/')}/_manifest"):
        return Manifest(spark, output).results()
    return spark.read.schema(OUTPUT_SCHEMA).json(output).select(*OUTPUT_SCHEMA.fieldNames())
