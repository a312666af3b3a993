"""Complete listings of document folders, made in tasks.

The ``binaryFile`` source silently leaves out hidden, underscore and empty files
and folders, so it cannot say how many documents there are. The listing can: it
holds one row per matching name, and whatever cannot be read becomes a failure
row later instead of vanishing.
"""

from __future__ import annotations

import fnmatch
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.paths import file_name
from docflow.schemas import DATED_LISTING_SCHEMA, LISTING_SCHEMA
from docflow.session import scratch_dir, ship_package
from docflow.sources.filesystem import entries, file_status, split_path

# Rows of an Arrow batch that a task hands over.
BATCH_ROWS = 10_000

_ARROW_SCHEMA = pa.schema([
    pa.field("document_path", pa.string()),
    pa.field("file_name", pa.string()),
    pa.field("file_size", pa.int64()),
    pa.field("is_file", pa.bool_()),
    pa.field("exists", pa.bool_()),
])


class InputNotFound(ValueError):
    """The input folder does not exist or is not a folder."""


class NoDocuments(ValueError):
    """The input folder holds no matching document."""


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while chunk := list(islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*chunk), schema)], schema=schema)


def full_path(path: str) -> str:
    """A path with scheme; one without is a local path."""
    root, rest = split_path(path)
    return f"{root}{rest}" if root not in ("", "file:") else f"file:{os.path.abspath(rest)}"


def real_path(path: str) -> str:
    """What ``entries`` gives as the real path of a folder with this full path."""
    scheme, rest = split_path(path)
    return os.path.realpath(rest) if scheme == "file:" else path


def compiled(pattern: str) -> re.Pattern:
    """A glob of names: ``*``, ``?``, ``[a-z]``, ``[^a-z]`` and ``{one,other}``."""
    alternatives = [""]
    for part in re.split(r"(\{[^{}]*\})", pattern):
        options = part[1:-1].split(",") if part.startswith("{") and part.endswith("}") else [part]
        alternatives = [a + o for a in alternatives for o in options]
    return re.compile("|".join(fnmatch.translate(a.replace("[^", "[!")) for a in alternatives), re.DOTALL)


def _is_folder(folder: str) -> bool:
    exists, is_file, _ = file_status(folder)
    return exists and not is_file


# A listing with what the next level needs: matching names, and folders of any name.
_LEVEL_SCHEMA = T.StructType([
    *DATED_LISTING_SCHEMA.fields,
    T.StructField("matches", T.BooleanType()),
    T.StructField("is_folder", T.BooleanType()),
    T.StructField("is_link", T.BooleanType()),
    T.StructField("real", T.StringType()),
])
_LEVEL_ARROW = pa.schema([
    *_ARROW_SCHEMA,
    pa.field("modified", pa.timestamp("us", tz="UTC")),
    pa.field("matches", pa.bool_()),
    pa.field("is_folder", pa.bool_()),
    pa.field("is_link", pa.bool_()),
    pa.field("real", pa.string()),
])


def folder_rows(folder: str, matches: Callable[[str], object], deep: bool) -> Iterator[tuple]:
    """The rows of one folder: matching names and, if ``deep``, its sub-folders.

    A folder that can't be read is a row itself, whatever its name: what it holds is lost.
    """
    try:
        for e in entries(folder):
            match = bool(matches(e.name))
            if match or (deep and e.is_folder):
                yield e.path, e.name, e.size, e.is_file, e.exists, e.modified, match, e.is_folder, e.is_link, e.real
    except OSError:
        name = os.path.basename(folder)
        if not matches(name):
            yield folder, name, 0, False, True, None, True, False, False, None


def _write_level(folders: DataFrame, matches: Callable[[str], object], deep: bool, path: str) -> dict:
    """Lists a table of folders into ``path``; returns how many rows, sub-folders and links to such it has."""

    def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                yield from _batches(folder_rows(folder, matches, deep), _LEVEL_ARROW)

    counts = Observation(path)
    level = folders.mapInArrow(list_folders, _LEVEL_SCHEMA).observe(
        counts,
        F.count_if("matches").alias("documents"),
        F.count_if("is_folder").alias("folders"),
        F.count_if(F.expr("is_folder AND is_link")).alias("links"),
    )
    level.write.parquet(path)
    return counts.get


def _next_folders(level: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The sub-folders of a level. With ``seen``, each real folder once, and none that was listed before."""
    folders = level.where("is_folder")
    if seen is None:
        return folders.select("document_path")
    first = folders.groupBy("real").agg(F.min(F.struct("is_link", "document_path")).alias("first"))
    return first.join(seen, "real", "left_anti").select("first.document_path")


def list_documents(
    spark: SparkSession, path: str, pattern: str = "*.pdf", recursive: bool = False, dated: bool = False
) -> DataFrame:
    """One row per entry of a folder whose name matches a glob pattern.

    Includes hidden, underscore and empty files, folders, dead links and pipes of a
    matching name. The pattern is case-sensitive; ``*.[pP][dD][fF]`` takes both cases.
    ``dated`` adds ``modified``, the time of the last change.

    With ``recursive`` the tree is listed level by level: the folders of a level are a
    table, dealt out anew, and a task lists its folders into the next one, so that a tree
    below a single folder is listed by as many tasks as it has folders. Links to folders
    are followed; each real folder is listed once, at the level that reaches it first, by
    its own path before that of a link, so that circles end. A folder that can't be read
    is a row.

    The levels are written below the scratch folder and read back: a listing is made once,
    and all that is done with it sees the same names. The driver lists nothing itself.
    Works for local folders and for every store that Arrow's file systems know; others can
    be given as a table of paths.
    """
    root = full_path(path)
    if not _is_folder(root):
        raise InputNotFound(f"no such folder: {path}")
    ship_package(spark)
    matches = compiled(pattern).match
    base = scratch_dir(spark, "listing")
    levels: list[DataFrame] = []
    documents, links, slots = 0, 0, spark.sparkContext.defaultParallelism
    seen = spark.range(1).select(F.lit(real_path(root)).alias("real"))
    folders = spark.range(0, 1, 1, 1).select(F.lit(root).alias("document_path"))
    while True:
        written = f"{base}/level-{len(levels)}"
        counts = _write_level(folders, matches, recursive, written)
        levels.append(spark.read.schema(_LEVEL_SCHEMA).parquet(written))
        documents, links = documents + counts["documents"], links + counts["links"]
        if not (recursive and counts["folders"]):
            break
        # Without links no folder can be reached twice.
        earlier = None
        if links:
            earlier = seen
            for level in levels[:-1]:
                earlier = earlier.unionByName(level.where("is_folder").select("real"))
        folders = _next_folders(levels[-1], earlier).repartition(min(counts["folders"], 16 * slots))
    if not documents:
        raise NoDocuments(f"no file matches {pattern} in {path}")
    names = (DATED_LISTING_SCHEMA if dated else LISTING_SCHEMA).fieldNames()
    found = spark.read.schema(_LEVEL_SCHEMA).parquet(*(f"{base}/level-{i}" for i in range(len(levels))))
    return found.where("matches").select(*names)


def checked_documents(paths: DataFrame, path_col: str = "document_path") -> DataFrame:
    """A table of paths in the form of a listing; each is looked up in a task.

    A path that does not exist stays, marked by ``exists``; its text stays as given.
    A null path is one that does not exist.
    """
    ship_package(paths.sparkSession)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                exists, is_file, size = file_status(path) if path is not None else (False, False, None)
                rows.append((path, None, size, is_file, exists))
            yield from _batches(iter(rows), _ARROW_SCHEMA)

    found = paths.select(F.col(path_col).cast("string").alias("document_path")).mapInArrow(look_up, LISTING_SCHEMA)
    return found.withColumn("file_name", file_name(F.col("document_path")))


def documents_from_paths(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """A work list from path strings, looked up in tasks; for long lists use a table."""
    rows = [(p,) for p in paths]
    table = spark.createDataFrame(rows, "document_path string")
    slots = spark.sparkContext.defaultParallelism
    return checked_documents(table.repartition(max(1, min(slots, len(rows)))))
