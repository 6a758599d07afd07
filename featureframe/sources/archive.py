"""Tar, zip and gzip archives of vector files.

A compressed stream can only be read from its start, so every archive is unpacked
once a session, by one task, piece by piece, into the shared folder. From there its members
are ordinary sources: split by rows, and safe when an executor is lost.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import shutil
import tarfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import PurePosixPath

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from featureframe.session import metadata_tasks, settle, shared_dir
from featureframe.sources.layers import filesystem_of, list_folder, open_binary
from featureframe.sources.listing import SOURCE_BY_EXTENSION

MEMBER_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("length", LongType()),
        StructField("source", StringType()),
        StructField("archive", StringType()),
        StructField("error", StringType()),
    ]
)
# what a damaged archive raises; other input errors fail the task
_UNREADABLE = (EOFError, gzip.BadGzipFile, tarfile.TarError, zipfile.BadZipFile, zlib.error)
_COPY_BYTES = 1 << 20


def archive_kind(prefix: str) -> str:
    """Archive kind named by a virtual-file-system prefix such as ``/vsitar/``."""
    for kind in ("tar", "zip", "gzip"):
        if f"vsi{kind}" in prefix:
            return kind
    raise ValueError(f'"{prefix}" names no archive kind; expecting /vsitar/, /vsizip/ or /vsigzip/.')


def unpack_archives(paths: DataFrame, prefix: str, count: int) -> DataFrame:
    """``(path, length, source, archive, error)`` of the sources inside every archive.

    An archive that cannot be read gives one row with an error and no source. What an
    earlier read of the session unpacked is used again while the archive's size and time
    stay as they were.
    """
    kind = archive_kind(prefix)
    root = f"{shared_dir(paths.sparkSession)}/unpacked-{kind}"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                yield _member_batch(_unpack_one(path, kind, f"{root}/{_identity(path)}"))

    members = paths.select("path").mapInArrow(unpack, MEMBER_SCHEMA)
    # a few rows per archive come back; unpacking again after a lost executor is harmless
    return settle(members.repartition(min(max(count, 1), metadata_tasks(paths.sparkSession))))


def _identity(path: str) -> str:
    """A name for an archive as it is now."""
    filesystem, name = filesystem_of(path)
    found = filesystem.get_file_info(name)
    return hashlib.sha256(f"{path}\0{found.size}\0{found.mtime_ns}".encode()).hexdigest()


def _unpack_one(path: str, kind: str, folder: str) -> list[tuple]:
    filesystem, final = filesystem_of(folder)
    if filesystem.get_file_info(final).type == pafs.FileType.Directory:
        return _sources(path, folder)
    attempt = f"{final}.{uuid.uuid4().hex}"
    filesystem.create_dir(attempt)
    try:
        for name, stream in _members(path, kind):
            # subfolders stay, so members of one name in two folders do; nothing leaves the attempt's folder
            parts = [part for part in PurePosixPath(name).parts if part not in ("/", "..")]
            filesystem.create_dir("/".join([attempt, *parts[:-1]]))
            with filesystem.open_output_stream("/".join([attempt, *parts])) as target:
                shutil.copyfileobj(stream, target, _COPY_BYTES)
    except _UNREADABLE as error:
        return [(path, 0, None, path, str(error))]
    try:
        filesystem.move(attempt, final)
    except OSError:
        # another attempt of this task may have got there first
        if filesystem.get_file_info(final).type != pafs.FileType.Directory:
            raise
    return _sources(path, folder)


def _members(path: str, kind: str) -> Iterator[tuple[str, object]]:
    with open_binary(path) as raw:
        if kind == "tar":
            with tarfile.open(fileobj=raw, mode="r|*") as archive:
                for member in archive:
                    if member.isfile():
                        yield member.name, archive.extractfile(member)
        elif kind == "zip":
            with zipfile.ZipFile(raw) as archive:
                for name in archive.namelist():
                    if not name.endswith("/"):
                        yield name, archive.open(name)
        else:
            yield os.path.basename(path).removesuffix(".gz"), gzip.open(raw)


def _sources(archive: str, folder: str) -> list[tuple]:
    """Every folder with shapefiles is one source, every other vector file its own."""
    rows: list[tuple] = []
    shapefile_bytes: dict[str, int] = {}
    for member, size in list_folder(folder, recursive=True):
        source = SOURCE_BY_EXTENSION.get(member.rsplit(".", 1)[-1].lower())
        if source == "shapefile":
            parent = member.rsplit("/", 1)[0]
            shapefile_bytes[parent] = shapefile_bytes.get(parent, 0) + size
        elif source:
            rows.append((member, size, source, archive, None))
    rows += [(parent, size, "shapefile", archive, None) for parent, size in shapefile_bytes.items()]
    return rows or [(archive, 0, None, archive, "The archive holds no vector file.")]


def _member_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(arrays, names=MEMBER_SCHEMA.names)
