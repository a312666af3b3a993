"""The batch job: list, convert, write, report."""

from __future__ import annotations

import argparse
import importlib
import logging
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docflow.config import IMAGE_MODES, ConvertConfig
from docflow.operators.results import failures_report, status_counts
from docflow.plans.convert import convert_directory, convert_listing
from docflow.schemas import OUTPUT_SCHEMA
from docflow.session import build_session, scratch_dir, ship_package
from docflow.sinks import Manifest, write_chunk, write_results
from docflow.sources.dealing import FILE_BYTES
from docflow.sources.listing import list_documents

log = logging.getLogger("docflow")

#: Bytes of documents in a chunk of a resumable job: what a lost run costs.
CHUNK_BYTES = 1 << 40


class JobReport(NamedTuple):
    total: int
    succeeded: int
    failed: int
    failures: DataFrame


def run_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    converter: Callable | None = None,
    config: ConvertConfig | None = None,
    pattern: str = "*.pdf",
    extensions: tuple[str, ...] = (".pdf",),
    recursive: bool = False,
    num_partitions: int | None = None,
    resume: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
    max_chunks: int | None = None,
) -> JobReport:
    """Convert a folder and write one JSON line per document.

    Documents are converted once: the counts are observed while the result is
    written, and the failures are read back from the small part of the output
    that holds them. No content reaches the driver.

    The output is replaced when the new one is whole. With ``resume`` it is continued
    instead: results are written in chunks of about ``chunk_bytes`` of input, each with a
    manifest of its documents, and a run converts what no earlier run has, or what has
    changed in size or time since. The report covers the results of all runs.
    ``max_chunks`` ends a run early. ``read_results`` reads either kind of output.
    """
    if resume:
        listing = list_documents(spark, input_path, pattern, recursive, dated=True)
        manifest = Manifest(spark, output_path)
        todo = _in_chunks(manifest.left(listing), chunk_bytes)
        numbers = sorted(r["chunk"] for r in todo.select("chunk").distinct().collect())
        for number in numbers[:max_chunks]:
            documents = todo.where(F.col("chunk") == number).drop("chunk")
            _run_chunk(manifest, documents, convert_listing(documents, converter, config, extensions, num_partitions))
        counts = manifest.counts()
        return _reported(JobReport(**counts, failures=failures_report(manifest.results("failed"))), output_path)
    results = convert_directory(
        spark,
        input_path,
        converter,
        config,
        pattern,
        extensions,
        recursive,
        num_partitions,
    )
    status = Observation("status")
    write_results(results.observe(status, *status_counts()), output_path)
    counts = status.get

    written = spark.read.schema(OUTPUT_SCHEMA)
    if not counts["failed"]:
        failed = failures_report(written.json(output_path))
    else:
        failed = failures_report(written.json(f"{output_path.rstrip('/')}/status=failed"))
    return _reported(JobReport(counts["total"], counts["succeeded"], counts["failed"], failed), output_path)


def _reported(report: JobReport, output_path: str) -> JobReport:
    log.info("documents: %d, succeeded: %d, failed: %d", *report[:3])
    if report.failed:
        log.warning("all failures are in %s/status=failed", output_path.rstrip("/"))
    return report


def _in_chunks(documents: DataFrame, chunk_bytes: int) -> DataFrame:
    """A written listing with a ``chunk`` per document: as many as hold ``chunk_bytes`` each on average."""
    spark = documents.sparkSession
    total = F.sum(F.coalesce("file_size", F.lit(0)) + F.lit(FILE_BYTES))
    chunks = max(1, -(-(documents.agg(total).first()[0] or 0) // chunk_bytes))
    path = scratch_dir(spark, "chunks")
    numbered = documents.withColumn("chunk", F.pmod(F.xxhash64("document_path", "file_size"), F.lit(chunks)))
    numbered.write.parquet(path)
    return spark.read.schema(numbered.schema).parquet(path)


def _run_chunk(manifest: Manifest, documents: DataFrame, results: DataFrame) -> None:
    number = len(manifest.chunks())
    status = Observation(f"chunk {number}")
    write_chunk(results.observe(status, *status_counts()), manifest.start(number))
    manifest.finish(number, documents, status.get)


def _load(name: str) -> Callable:
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="docflow", description="Convert a folder of documents.")
    parser.add_argument("--input", "--input-dir", default="assets", help="folder, any Hadoop URI")
    parser.add_argument("--output", "--output-file", default="output/results.jsonl", help="folder for JSON-lines part files")
    parser.add_argument("--converter", default="html", help="'html', or module:factory of a plug-in")
    parser.add_argument("--pattern", default=None, help="glob of file names")
    parser.add_argument("--extension", action="append", help="accepted suffix, repeatable")
    parser.add_argument("--recursive", action="store_true")
    parser.add_argument("--num-partitions", type=int, default=None)
    parser.add_argument("--timeout", type=float, default=300.0, help="seconds per document")
    parser.add_argument("--image-mode", choices=IMAGE_MODES, default="embedded")
    parser.add_argument("--resume", action="store_true", help="go on from what earlier runs have converted")
    parser.add_argument("--chunk-bytes", type=int, default=CHUNK_BYTES, help="input of one chunk of a resumable job")
    parser.add_argument("--isolate", action="store_true", help="survive crashes of the converter")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """Command-line entry; errors are raised, so spark-submit sees a non-zero exit."""
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    args = _arguments(argv)
    native = args.converter == "html"
    converter = None if native else _load(args.converter)
    spark = build_session("docflow")
    try:
        ship_package(spark)
        run_job(
            spark,
            args.input,
            args.output,
            converter,
            ConvertConfig(
                timeout_s=args.timeout, image_mode=args.image_mode, isolate=args.isolate
            ),
            pattern=args.pattern or ("*.html" if native else "*.pdf"),
            extensions=tuple(args.extension or ([".html", ".htm"] if native else [".pdf"])),
            recursive=args.recursive,
            num_partitions=args.num_partitions,
            resume=args.resume,
            chunk_bytes=args.chunk_bytes,
        )
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
