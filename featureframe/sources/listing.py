"""Find vector files: which paths to read, and as what."""

from __future__ import annotations

import fnmatch
import os
import re
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureframe.session import active_session, metadata_tasks, settle
from featureframe.sources.layers import folder_entries

# File extension -> source that reads it
SOURCE_BY_EXTENSION = {
    "gpkg": "geopackage",
    "sqlite": "geopackage",
    "db": "geopackage",
    "shp": "shapefile",
    "dbf": "shapefile",
    "json": "geojson",
    "geojson": "geojson",
    "geojsonl": "geojson",
    "geojsons": "geojson",
    "ndjson": "geojson",
    "gml": "gml",
    "xml": "gml",
}


def local_path(path: Column) -> Column:
    """``file:/a/b`` -> ``/a/b``; other schemes stay."""
    return F.regexp_replace(path, "^file:/+", "/")


def parent(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(base_name(path), r"\.([^.]*)$", 1))


def source_of(path: Column) -> Column:
    """Name of the source that reads a path; null for files no source reads."""
    pairs = [F.lit(part) for pair in SOURCE_BY_EXTENSION.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), extension(path))


def _files(spark: SparkSession, root: str, glob: str, recursive: bool) -> DataFrame:
    """Files in a folder, or also below it, whose name matches; no file content is read.

    A flat listing names the matches, so Spark does not look into subfolders. Names that
    begin with ``_`` or ``.``, which Spark leaves out, are added.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    # a path without a scheme is one of the mounted file system, whatever Spark's default is
    place = escaped(root) if "://" in root else f"file://{escaped(root)}"
    try:
        listed = reader.option("pathGlobFilter", glob).load(place) if recursive else reader.load(f"{place}/{glob}")
        files = listed.select(local_path(F.col("path")).alias("path"), "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or (recursive and "://" in root):
            raise
        files = spark.createDataFrame([], "path string, length long")
    hidden = _hidden_files(spark, root, glob, recursive)
    return files if hidden is None else files.unionByName(hidden)


def _left_out(name: str) -> bool:
    """Whether Spark leaves a file or folder out by its name."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _hidden_files(spark: SparkSession, root: str, glob: str, recursive: bool) -> DataFrame | None:
    """Matching files Spark leaves out, by their own name or a folder's; None where there are none.

    Folders are looked into level by level, those of a level by many tasks, until no folder is left.
    """
    matches = re.compile(_as_regex(glob)).fullmatch

    def candidates(folder: str, inside: bool) -> Iterator[tuple[str, int | None, bool]]:
        """Folders to look into, and hidden files that match."""
        for path, length in folder_entries(folder):
            name = path.rsplit("/", 1)[-1]
            hidden = inside or _left_out(name)
            if (recursive if length is None else hidden and matches(name)):
                yield path, length, hidden

    if next(candidates(root, False), None) is None:
        return None

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.bool_()]
        for batch in batches:
            for folder, inside in zip(batch["path"].to_pylist(), batch["hidden"].to_pylist()):
                found = candidates(folder, inside)
                while rows := list(islice(found, _ENTRIES_PER_BATCH)):
                    yield pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)], _ENTRY_NAMES)

    level = spark.createDataFrame([(root, None, False)], _ENTRY)
    files, folders = [], 1
    while folders:
        dealt = level.repartition(min(folders, metadata_tasks(spark)), F.xxhash64("path"))
        entries = settle(dealt.mapInArrow(look, _ENTRY))
        files.append(entries.filter("length is not null").select("path", "length"))
        level = entries.filter("length is null")
        folders = level.count()
    return reduce(DataFrame.union, files)


_ENTRY, _ENTRY_NAMES = "path string, length long, hidden boolean", ["path", "length", "hidden"]
_ENTRIES_PER_BATCH = 10_000


def _as_regex(glob: str) -> str:
    """A pattern as Spark's globs have it, with alternatives in braces."""
    parts = re.split(r"(\{[^{}]*\})", glob)
    return "".join(
        f"(?:{'|'.join(map(_as_regex, part[1:-1].split(',')))})" if part.startswith("{") and part.endswith("}")
        else fnmatch.translate(part).removeprefix("(?s:").removesuffix(")\\Z").removesuffix(")\\z")
        for part in parts if part
    )


def escaped(path: str) -> str:
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def _root(path: str) -> str:
    return path.rstrip("/") if "://" in path else os.path.abspath(path)


def list_files(
    path: str,
    pattern: str = "*",
    suffix: str = "*",
    recursive: bool = False,
    spark: SparkSession | None = None,
) -> DataFrame:
    """``(path, length)`` of the files matching ``{pattern}.{suffix}`` in a folder."""
    session = active_session(spark)
    root = _check_folder(path)
    files = _files(session, root, f"{pattern}.{suffix.strip('.')}", recursive)
    # a folder whose name matches is listed too
    return files if recursive else files.filter(parent(F.col("path")) == root)


def list_folders(
    path: str,
    pattern: str = "*",
    suffix: str = "*",
    recursive: bool = False,
    spark: SparkSession | None = None,
) -> DataFrame:
    """``(path, length)`` of folders matching ``{pattern}.{suffix}`` that hold shapefiles."""
    session = active_session(spark)
    root = _check_folder(path)
    members = _files(session, root, "*.{shp,SHP,dbf,DBF}", True).select(parent(F.col("path")).alias("path"), "length")
    name = fnmatch.translate(f"{pattern}.{suffix.strip('.')}")
    matching = members.filter(base_name(F.col("path")).rlike(name)).filter(F.col("path") != root)
    if not recursive:
        matching = matching.filter(parent(F.col("path")) == root)
    return matching.groupBy("path").agg(F.sum("length").alias("length"))


def _check_folder(path: str) -> str:
    root = _root(path.removeprefix("file://") if path.startswith("file:///") else path)
    if "://" not in root and not os.path.isdir(root):
        raise NotADirectoryError(f"{path} is not a folder.")
    return root


class Sources(NamedTuple):
    """What a read found: ``rows`` of ``(path, length, source)`` and a summary of them.

    ``packed`` tells that the rows are plain files straight from the listing, which
    Spark has already packed into partitions by size. ``first`` is the first path
    some source reads, with that source.
    """

    rows: DataFrame
    packed: bool
    count: int
    total_bytes: int
    largest_bytes: int
    kinds: set[str]
    first: tuple[str, str] | None

    def names(self) -> DataFrame:
        """The rows in few partitions, for jobs that do not read the files."""
        return few_partitions(self.rows)


def few_partitions(rows: DataFrame) -> DataFrame:
    return rows.coalesce(metadata_tasks(rows.sparkSession))


def summarise(rows: DataFrame, packed: bool) -> Sources:
    """One pass over the listing for all that planning a read asks of it."""
    readable = F.when(F.col("source").isNotNull(), F.struct("path", "source"))
    summary = few_partitions(rows).agg(
        F.count("*").alias("count"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total"),
        F.coalesce(F.max("length"), F.lit(0)).alias("largest"),
        F.collect_set("source").alias("kinds"),
        F.min(readable).alias("first"),
    ).first()
    first = tuple(summary["first"]) if summary["first"] else None
    return Sources(rows, packed, summary["count"], summary["total"], summary["largest"], set(summary["kinds"]), first)


def find_sources(
    path: str,
    pattern: str = "*",
    suffix: str = "*",
    recursive: bool = False,
    spark: SparkSession | None = None,
    folders: bool = True,
) -> Sources:
    """Every file, and unless told otherwise shapefile folder, that matches ``{pattern}.{suffix}``."""
    arguments = (path, pattern, suffix, recursive, spark)
    files = summarise(list_files(*arguments).withColumn("source", source_of(F.col("path"))), packed=True)
    if folders and suffix.strip(".").lower() not in SOURCE_BY_EXTENSION:
        # grouping members into folders is a shuffle, so it is done once
        grouped = settle(list_folders(*arguments).withColumn("source", F.lit("shapefile")))
        found = summarise(grouped, packed=False)
        if found.count and files.count:
            return summarise(files.rows.unionByName(grouped), packed=False)
        files = found if found.count else files
    if not files.count:
        raise FileNotFoundError(
            f"Nothing matches {path=}, {pattern=}, {suffix=}, {recursive=}."
        )
    return files


def archive_paths(paths: DataFrame, prefix: str, column: str = "path", output: str = "path") -> DataFrame:
    """Add the virtual-file-system spelling ``/prefix//path`` of a path column."""
    head = "/" + prefix.strip("/") + "//"
    return paths.withColumn(output, F.concat(F.lit(head), F.ltrim(F.col(column), F.lit("/"))))
