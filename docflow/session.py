"""Session set-up, code shipping and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Sensible for documents: rows are large and few, and conversion is CPU-bound.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Documents are large; small batches bound the memory of a Python worker.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # One worker serves many tasks, so a converter's imports are paid once.
    "spark.python.worker.reuse": "true",
    "spark.python.worker.faulthandler.enabled": "true",
    "spark.sql.execution.pyspark.udf.faulthandler.enabled": "true",
    # Lets a task write its succeeded and failed rows side by side, unsorted.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


_shipped: dict[str, str] = {}


def build_session(app_name: str = "docflow", **conf: str) -> SparkSession:
    """A session with the package's defaults; master and resources come from spark-submit.

    Option names in ``conf`` may use ``__`` for the dots.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ship_package(spark: SparkSession) -> str:
    """Send this package to every executor; returns the path of the archive.

    Needed on a cluster when the package is not installed on the executors or
    passed with ``--py-files``. The archive is written on the driver, where
    ``addPyFile`` reads it. Further calls in the same application do nothing.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return _shipped[application]
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="docflow-"), "docflow.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped[application] = archive
    return archive


def bound_batches(spark: SparkSession) -> None:
    """Limits the bytes of an Arrow batch in a session that sets no limit itself.

    Executor and Python worker both hold a batch as a whole, and by Spark's defaults it
    may have 10,000 documents and 64 MB.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, "4m")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder that every executor can reach.

    Lives below the folder named by ``spark.checkpoint.dir``. Only a local
    session, whose executors share the driver's disk, may do without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="docflow-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
