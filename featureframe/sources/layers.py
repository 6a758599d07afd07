"""What a format module tells about a layer, and how it hands over rows."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs

# Rows are handed to Spark in batches of at most this many rows and about this many bytes
BATCH_ROWS = 8192
BATCH_BYTES = 64 << 20


class NotVectorData(ValueError):
    """The file itself is why it cannot be read; a tolerant read passes over it.

    Whatever else goes wrong, such as a failing disk, a lock or an absent folder, is
    another error and fails the task, or rows of healthy files would be lost.
    """


class Attribute(NamedTuple):
    """One attribute of a layer with its OGR type pair."""

    name: str
    ogr_type: int
    ogr_subtype: int


@dataclass
class Layer:
    """A named table of one data source.

    ``first_id`` and ``last_id`` bound the ids a row range selects on (record
    ordinals or rowids); both are None where the layer cannot be read in ranges.
    """

    name: str
    feature_count: int
    attributes: list[Attribute]
    first_id: int | None = None
    last_id: int | None = None


class Rows(NamedTuple):
    """Some rows of a layer: attribute arrays by name, and WKB."""

    count: int
    columns: dict[str, pa.Array]
    geometry: pa.Array | None


RowBatches = Iterator[Rows]


def filesystem_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a mounted path or a URI, and the path's name in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def open_binary(path: str) -> BinaryIO:
    """A seekable file for a mounted path or a URI."""
    if "://" not in path:
        return open(path, "rb")
    filesystem, name = filesystem_of(path)
    return filesystem.open_input_file(name)


def absent(path: str) -> Exception:
    """Why a path cannot be found: the file is gone, or its whole folder cannot be reached."""
    filesystem, name = filesystem_of(path.rstrip("/"))
    folder = filesystem.get_file_info(os.path.dirname(name) or ".")
    if folder.type == pafs.FileType.Directory:
        return NotVectorData(f"{path} does not exist.")
    return FileNotFoundError(f"The folder of {path} cannot be reached.")


def existing(paths: list[str]) -> str | None:
    """The first of some paths in one folder that is a file, without opening any."""
    filesystem, _ = filesystem_of(paths[0])
    found = filesystem.get_file_info([filesystem_of(path)[1] for path in paths])
    return next((path for path, info in zip(paths, found) if info.type == pafs.FileType.File), None)


def folder_entries(path: str) -> Iterator[tuple[str, int | None]]:
    """Full path and size of what is right inside a folder; a folder's size is None."""
    if "://" not in path:
        with os.scandir(path) as entries:
            for entry in entries:
                yield entry.path, None if entry.is_dir() else entry.stat().st_size
        return
    filesystem, name = filesystem_of(path.rstrip("/"))
    for entry in filesystem.get_file_info(pafs.FileSelector(name)):
        is_folder = entry.type == pafs.FileType.Directory
        yield path.rstrip("/") + entry.path[len(name) :], None if is_folder else entry.size


def list_folder(path: str, recursive: bool = False) -> list[tuple[str, int]]:
    """Full paths and sizes of the files in a folder, sorted by path."""
    filesystem, name = filesystem_of(path.rstrip("/"))
    entries = filesystem.get_file_info(pafs.FileSelector(name, recursive=recursive))
    files = [entry for entry in entries if entry.type == pafs.FileType.File]
    return sorted((path.rstrip("/") + entry.path[len(name) :], entry.size) for entry in files)
