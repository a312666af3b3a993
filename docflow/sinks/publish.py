"""Replacing a result only when the new one is whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    files, place = _file_system(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    if target.getParent() is not None:
        files.mkdirs(target.getParent())
    if not files.rename(place, target):
        raise OSError(f"cannot rename {old} to {new}")


def _beside(path: str, mark: str) -> str:
    """A hidden neighbour of a folder, in the same file system."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}.{mark}" if folder or path.startswith("/") else f".{name}.{mark}"


def recover(spark: SparkSession, path: str) -> None:
    """Puts back a result that was moved away by a run that ended before the new one took its place."""
    previous = _beside(path, "previous")
    if not path_exists(spark, path) and path_exists(spark, previous):
        _rename(spark, previous, path)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Lets ``write`` make a folder beside ``path``, then puts it in the place of ``path``.

    A failing ``write`` leaves the old folder as it was, and nothing beside it. The old one
    is moved away, not deleted, before the new one takes its name; whatever ends the run in
    between, the next one puts it back first. File systems rename folders in one step;
    object stores copy, one object after another.
    """
    path = path.rstrip("/")
    recover(spark, path)
    new, previous = _beside(path, uuid.uuid4().hex), _beside(path, "previous")
    try:
        write(new)
    except BaseException:
        remove_path(spark, new)
        raise
    remove_path(spark, previous)
    if path_exists(spark, path):
        _rename(spark, path, previous)
    try:
        _rename(spark, new, path)
    except BaseException:
        recover(spark, path)
        raise
    remove_path(spark, previous)
