"""File access from inside tasks, for any file system pyarrow can reach."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyarrow import fs

from mediacurate.functions.layout import normalise_root


class _Systems(dict):
    """Clients by scheme and authority, so that a task opens one for all its files; it starts with none."""

    def __reduce__(self):
        return _Systems, ()


_SYSTEMS = _Systems()


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` and the path inside it."""
    plain = normalise_root(uri)
    if "://" not in plain:
        return fs.LocalFileSystem(), plain
    scheme, rest = plain.split("://", 1)
    authority, _, inner = rest.partition("/")
    # Spark's names for the store that pyarrow calls s3.
    known = "s3" if scheme in ("s3a", "s3n") else scheme
    base = f"{known}://{authority}/"
    if base not in _SYSTEMS:
        _SYSTEMS[base] = fs.FileSystem.from_uri(base)
    system, top = _SYSTEMS[base]
    return system, f"{top.rstrip('/')}/{inner}" if top else inner


def read_bytes(uri: str) -> bytes:
    system, path = locate(uri)
    with system.open_input_stream(path) as stream:
        return stream.read()


def read_or_none(uri: str) -> bytes | None:
    try:
        return read_bytes(uri)
    except FileNotFoundError:
        return None


def write_bytes(uri: str, content: bytes) -> None:
    system, path = locate(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as stream:
        stream.write(content)


def delete_file(uri: str) -> bool:
    """True when the file is no longer there, whoever removed it: a task may run twice."""
    system, path = locate(uri)
    try:
        system.delete_file(path)
    except FileNotFoundError:
        return True
    except OSError:
        return False
    return True


@contextmanager
def open_at(uri: str) -> Iterator[pa.NativeFile]:
    """A file with ``size()`` and ``read_at(n, at)``."""
    system, path = locate(uri)
    with system.open_input_file(path) as handle:
        yield handle


def children(uri: str) -> Iterator[tuple[str, bool, int]]:
    """Path, is-directory and length of everything directly under ``uri``."""
    system, path = locate(uri)
    if isinstance(system, fs.LocalFileSystem):
        yield from _local_children(path)
        return
    whole = normalise_root(uri)
    prefix = whole[: len(whole) - len(path)]
    for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        yield prefix + info.path, info.type == fs.FileType.Directory, info.size or 0


def _local_children(path: str) -> Iterator[tuple[str, bool, int]]:
    """Entry by entry, so that a very large directory is never held as a list."""
    if not os.path.isdir(path):
        return
    with os.scandir(path) as entries:
        for entry in entries:
            is_dir = entry.is_dir()
            yield entry.path, is_dir, 0 if is_dir else _size(entry)


def _size(entry: os.DirEntry) -> int:
    try:
        return entry.stat().st_size
    except OSError:  # gone meanwhile, or a link to nothing
        return 0


def in_frames(rows: Iterator[tuple], columns: list[str], size: int = 10_000) -> Iterator[pd.DataFrame]:
    """Bounded frames from an unbounded run of tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pd.DataFrame(held, columns=columns)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns)
