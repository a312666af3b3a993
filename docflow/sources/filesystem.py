"""Files by path, on the driver and inside tasks, without a call into the JVM per file."""

from __future__ import annotations

import contextlib
import fcntl
import mmap
import os
import re
import stat
import tempfile
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs

_SCHEME = re.compile(r"^([a-zA-Z][a-zA-Z0-9+.-]*):(//([^/]*))?(.*)$", re.DOTALL)
# Schemes of Hadoop file systems under the names their clients know.
_SAME = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfss": "abfss", "abfs": "abfs"}


@lru_cache(64)
def _remote(scheme: str, host: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(f"{_SAME.get(scheme, scheme)}://{host}/")


def split_path(path: str) -> tuple[str, str]:
    """What comes before the path proper, such as ``file:`` or ``s3a://bucket``, and the path."""
    found = _SCHEME.match(path)
    if not found:
        return "", path
    scheme, host, rest = found[1], found[3] or "", found[4]
    if scheme.lower() == "file":
        return "file:", rest
    return f"{scheme}://{host}", rest


def _resolve(path: str) -> tuple[fs.FileSystem | None, str]:
    """The file system and the path in it; None for local files."""
    root, rest = split_path(path)
    if root in ("", "file:"):
        return None, rest
    scheme, _, host = root.partition("://")
    system, base = _remote(scheme.lower(), host)
    return system, f"{base.rstrip('/')}/{rest.lstrip('/')}"


def _time(nanoseconds: int) -> datetime:
    """Microseconds since 1970, as a time of UTC; the rest is cut off."""
    return datetime.fromtimestamp(0, UTC) + timedelta(microseconds=nanoseconds // 1000)


def file_status(path: str) -> tuple[bool, bool, int | None]:
    """Whether there is such an entry, whether it is a file, and its size."""
    system, name = _resolve(path)
    if system is None:
        try:
            found = os.stat(name)
        except (OSError, ValueError):
            return False, False, None
        return True, stat.S_ISREG(found.st_mode), found.st_size if stat.S_ISREG(found.st_mode) else 0
    info = system.get_file_info(name)
    return info.type != fs.FileType.NotFound, info.type == fs.FileType.File, info.size


class Entry(NamedTuple):
    """What a folder holds under one name. ``real`` tells folders apart, however they are reached."""

    path: str
    name: str
    size: int | None
    is_file: bool
    exists: bool
    is_folder: bool
    is_link: bool
    real: str | None
    modified: datetime | None


def _local_entry(path: str, found: os.DirEntry) -> Entry:
    link = found.is_symlink()
    try:
        status = found.stat()
    except OSError:
        # A link to nothing, or one that leads in a circle.
        return Entry(path, found.name, None, False, False, False, link, None, None)
    is_file, is_folder = stat.S_ISREG(status.st_mode), stat.S_ISDIR(status.st_mode)
    real = os.path.realpath(found.path) if is_folder else None
    return Entry(path, found.name, status.st_size if is_file else 0, is_file, True, is_folder, link, real, _time(status.st_mtime_ns))


def entries(folder: str) -> Iterator[Entry]:
    """Everything in a folder, hidden or not; what can't be looked up is an entry, too."""
    system, name = _resolve(folder)
    base = folder.rstrip("/")
    if system is None:
        with os.scandir(name or "/") as found:
            for entry in found:
                yield _local_entry(f"{base}/{entry.name}", entry)
        return
    for info in system.get_file_info(fs.FileSelector(name)):
        is_file, is_folder = info.type == fs.FileType.File, info.type == fs.FileType.Directory
        path = f"{base}/{info.base_name}"
        exists, real = info.type != fs.FileType.NotFound, path if is_folder else None
        yield Entry(path, info.base_name, info.size or 0, is_file, exists, is_folder, False, real, info.mtime)


def read_file(path: str) -> bytes:
    """The bytes of a file, held once."""
    system, name = _resolve(path)
    if system is None:
        with open(name, "rb") as file:
            return file.read()
    with system.open_input_file(name) as file:
        return file.read(file.size())


#: Bytes of a remote file that are held while it is copied.
COPY_BYTES = 8 << 20


def mapped_file(path: str) -> pa.Buffer:
    """The bytes of a file, mapped: no memory holds them. A remote file is copied to one without a name first."""
    system, name = _resolve(path)
    if system is None:
        if not os.path.getsize(name):
            return pa.py_buffer(b"")
        with pa.memory_map(name) as file:
            return file.read_buffer()
    with tempfile.TemporaryFile() as local, system.open_input_stream(name) as file:
        while piece := file.read(COPY_BYTES):
            local.write(piece)
        local.flush()
        return pa.py_buffer(mmap.mmap(local.fileno(), 0, access=mmap.ACCESS_READ) if local.tell() else b"")


#: Files of more bytes are held one at a time by the workers of an executor.
LARGE_BYTES = 256 << 20


class Unread(NamedTuple):
    """A file that is read where it is converted."""

    path: str
    size: int

    @contextlib.contextmanager
    def held(self) -> Iterator[list[bytes | None]]:
        """A list with the file's bytes, None if it can't be read; the block may empty it.

        Of large files the processes with the same folder for temporary files hold one at a time.
        """
        if self.size <= LARGE_BYTES:
            yield [self._bytes()]
            return
        with open(os.path.join(tempfile.gettempdir(), f"docflow-{os.getuid()}.lock"), "ab") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            yield (found := [self._bytes()])
            found.clear()

    def _bytes(self) -> bytes | None:
        try:
            return read_file(self.path)
        except OSError:
            return None


def names_in(folder: str) -> list[str]:
    system, name = _resolve(folder)
    if system is None:
        return os.listdir(name)
    return [info.base_name for info in system.get_file_info(fs.FileSelector(name))]


def make_folder(folder: str) -> None:
    system, name = _resolve(folder)
    if system is None:
        os.makedirs(name, exist_ok=True)
    else:
        system.create_dir(name)


def open_input(path: str) -> pa.NativeFile:
    system, name = _resolve(path)
    return (system or fs.LocalFileSystem()).open_input_file(name)


def open_output(path: str) -> pa.NativeFile:
    system, name = _resolve(path)
    return (system or fs.LocalFileSystem()).open_output_stream(name)


def rename(old: str, new: str) -> None:
    system, name = _resolve(old)
    (system or fs.LocalFileSystem()).move(name, _resolve(new)[1])
