"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
Each query runs over whole tables into a sink that discards the rows. The first
run warms the session up and is not counted; the better of two more is.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docflow.plans import queries as q  # noqa: E402
from docflow.session import build_session  # noqa: E402

HEADLINE = [
    "convert_pages",
    "html_to_markdown_full",
    "document_blocks",
    "document_tables",
    "table_markdown",
    "convert_python",
    "document_metadata",
    "validate_documents",
    "status_summary",
    "failures_report",
    "preview",
    "jsonl_roundtrip",
    "list_documents",
    "read_content",
    "convert_directory",
    "stream_convert",
]
# Documents each of these converts, for the rate.
DOCUMENTS = {"convert_pages": "pages", "convert_python": "documents", "table_markdown": "orders"}


def isolated_python(spark, folder):
    """The plug-in of ``convert_python`` in child processes."""
    return q._first_line(q._text_results(spark, folder, q.length_converter, isolate=True))


def timed(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "docflow-bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: q.QUERIES[name] for name in HEADLINE} | {"convert_python_isolated": isolated_python}
    seconds = {}
    for name, query in queries.items():
        timed(spark, query, folder)
        seconds[name] = round(min(timed(spark, query, folder) for _ in range(2)), 3)
    rates = {
        name: round(spark.read.parquet(f"{folder}/{table}.parquet").count() / seconds[name])
        for name, table in (DOCUMENTS | {"convert_python_isolated": "documents"}).items()
    }
    spark.stop()
    print(
        json.dumps({
            "metric": "total time of headline queries",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "documents_per_sec": rates,
            "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        })
    )


if __name__ == "__main__":
    main()
