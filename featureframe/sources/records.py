"""Text files of features, cut into one record per feature inside the tasks.

A format module says where a file's features are (``locate``), what a block of it does to
what follows (``summary``, ``after``), where it can be cut (``cut``), and yields the features
of a byte range (``features``). Files up to a size
are read by the task Spark's listing packed them into. Larger ones are planned first, one
row per range, and read by as many tasks.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from types import ModuleType
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField

from featureframe.functions.boxes import Box
from featureframe.plans.catalog import LayerIdentifier
from featureframe.plans.chunks import place_evenly
from featureframe.session import settle
from featureframe.sources.layers import NotVectorData, absent, open_binary

BLOCK_BYTES = 8 << 20
_FEATURES_PER_BATCH = 2048
_TEXT_PER_BATCH = 32 << 20

FEATURES = "path string, feature string"
RANGES = "path string, layer_name string, key string, start long, stop long"
FOUND = "path string, layer_index int, layer_name string, feature_count long, error string"


class Located(NamedTuple):
    """A layer of one text file; ``key`` is what its module needs to find its features."""

    layer_name: str
    key: str


def opened(path: str) -> BinaryIO:
    try:
        return open_binary(path)
    except FileNotFoundError:
        raise absent(path) from None
    except IsADirectoryError:
        raise NotVectorData(f"{path} is a folder.") from None


def decoded(path: str, text: bytes, encoding: str) -> str:
    try:
        return text.decode(encoding)
    except UnicodeDecodeError as error:
        raise ValueError(f"{path} has a feature that is not {encoding}: {error}") from None


def size_of(file: BinaryIO) -> int:
    return file.seek(0, os.SEEK_END) if hasattr(file, "seekable") else file.size()


def blocks(file: BinaryIO, start: int, stop: int | None, most: int | None = None) -> Iterator[bytes]:
    """The bytes from ``start`` up to ``stop`` or the end, a block of at most ``most`` bytes at a time."""
    most = BLOCK_BYTES if most is None else most
    file.seek(start)
    while stop is None or start < stop:
        block = file.read(most if stop is None else min(most, stop - start))
        if not block:
            return
        start += len(block)
        yield block


def _located(module: ModuleType, path: str, layer: LayerIdentifier, mode: str) -> Located | None:
    try:
        return module.locate(path, layer)
    except NotVectorData:
        if mode == "FAILFAST":
            raise
        return None


def _batches(path: str, features: Iterator[str]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(held)), pa.array(held)], ["path", "feature"])

    for feature in features:
        held.append(feature)
        size += len(feature)
        if len(held) == _FEATURES_PER_BATCH or size >= _TEXT_PER_BATCH:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def whole_files(files: DataFrame, module: ModuleType, layer: LayerIdentifier, mode: str = "PERMISSIVE") -> DataFrame:
    """``(path, feature)`` of the layer, every file read by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                if found := _located(module, path, layer, mode):
                    yield from _batches(path, module.features(path, found.key, None, None))

    return files.select("path").mapInArrow(run, FEATURES)


def _states(module: ModuleType, summaries: list) -> list:
    """The state each block begins in, from the summaries of those before it; None after the last feature."""
    states = [module.BEGIN]
    for one in summaries[:-1]:
        states.append(None if states[-1] is None else module.after(states[-1], one))
    return states


def plan(module: ModuleType, path: str, key: str, step: int) -> list[tuple[int, int | None]]:
    """What :func:`planned` finds for one file, in this process."""
    starts = module.block_starts(path, key, step)
    stops = [*starts[1:], None]
    states = _states(module, [module.summary(path, *ends) for ends in zip(starts, stops)])
    cuts = [module.cut(path, *ends) for ends in zip(starts, stops, states) if ends[2] is not None]
    cuts = [starts[0], *(cut for cut in cuts[1:] if cut is not None)]
    return list(zip(cuts, [*cuts[1:], None]))


def planned(files: DataFrame, module: ModuleType, layer: LayerIdentifier, step: int, mode: str) -> DataFrame:
    """Ranges of about ``step`` bytes that begin and end between features.

    Whether a place is between features depends on all before it. So every block is summed
    up by a task of its own, for each state it may begin in; the summaries of a file, one row
    a block, then give the state each block does begin in, and tasks look for the first
    feature from there.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                if found := _located(module, path, layer, mode):
                    starts = module.block_starts(path, found.key, step)
                    n = len(starts)
                    columns = [[path] * n, [found.layer_name] * n, [found.key] * n]
                    arrays = [*(pa.array(column) for column in columns), *(pa.array(c, pa.int64()) for c in (starts, [*starts[1:], None]))]
                    yield pa.RecordBatch.from_arrays(arrays, ["path", "layer_name", "key", "start", "stop"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(module.summary(row["path"], row["start"], row["stop"])) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "told"])

    def told(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("start")
        states = _states(module, [json.loads(one) for one in rows["told"].to_pylist()])
        found = pa.array([None if state is None else json.dumps(state) for state in states], pa.string())
        return rows.set_column(rows.schema.get_field_index("told"), "told", found)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [module.cut(row["path"], row["start"], row["stop"], json.loads(row["told"])) for row in batch.to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("start"), "start", pa.array(found, pa.int64()))

    with_told = f"{RANGES}, told string"
    found = settle(files.select("path").mapInArrow(locate, RANGES))
    summaries = place_evenly(found).mapInArrow(summed, with_told)
    # one row per block
    states = settle(summaries.groupBy("path").applyInArrow(told, with_told).filter("told is not null"))
    first = F.min("start").over(Window.partitionBy("path"))
    begins = states.withColumn("begin", first)
    first_range = begins.filter(F.col("start") == F.col("begin")).select(*found.columns)
    later = place_evenly(settle(begins.filter(F.col("start") > F.col("begin")).drop("begin"))).mapInArrow(cut, with_told)
    cuts = first_range.union(later.filter("start is not null").select(*found.columns))
    following = F.lead("start").over(Window.partitionBy("path").orderBy("start"))
    return cuts.withColumn("stop", following)


def ranged(ranges: DataFrame, module: ModuleType) -> DataFrame:
    """``(path, feature)`` of planned ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batches(row["path"], module.features(row["path"], row["key"], row["start"], row["stop"]))

    return ranges.select("path", "key", "start", "stop").mapInArrow(run, FEATURES)


def found_layers(files: DataFrame, module: ModuleType, layer: LayerIdentifier = None, count: bool = False) -> DataFrame:
    """``(path, layer_index, layer_name, feature_count, error)`` of every file: the layer asked for, or,
    to ``count``, all of them with their features."""

    def look(path: str) -> list[tuple]:
        try:
            if count:
                return [(path, at, name, n, None) for at, (name, n) in enumerate(module.layers(path))]
            return [(path, None, module.locate(path, layer).layer_name, None, None)]
        except NotVectorData as error:
            return [(path, None, None, None, str(error))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string()]
        names = ["path", "layer_index", "layer_name", "feature_count", "error"]
        for batch in batches:
            rows = [row for path in batch["path"].to_pylist() for row in look(path)]
            if rows:
                arrays = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return files.select("path").mapInArrow(run, FOUND)


def chosen(names: list[str], layer: LayerIdentifier, path: str) -> int:
    """Place of the named layer, the layer at an index, or the first one."""
    if isinstance(layer, str):
        if layer not in names:
            raise NotVectorData(f"{path} has no layer {layer!r}, only {names}.")
        return names.index(layer)
    if not 0 <= (layer or 0) < len(names):
        raise NotVectorData(f"{path} has no layer {layer}, only {names}.")
    return layer or 0


def near(parsed: DataFrame, geometry: Column, box: Box | None) -> DataFrame:
    """Rows whose geometry, a column of well-known binary, has bounds that meet the box; all rows without one."""
    return parsed if box is None else parsed.filter(box.meets_wkb(geometry))


def fitted(text: Column, field: StructField, path: Column, strict: bool) -> Column:
    """``typed``; where files are not to be fitted, a value that is none of the type is an error."""
    value = typed(text, field.dataType)
    if not strict:
        return value
    kind = field.dataType.simpleString()
    hint = f" has a value of {field.name} that is no {kind}; set coerce_to_schema=True to fit it."
    lost = text.isNotNull() & (F.trim(text.cast("string")) != "") & value.isNull()
    return F.when(lost, F.raise_error(F.concat(path, F.lit(hint))).cast(field.dataType)).otherwise(value)


def typed(text: Column, data_type: DataType) -> Column:
    """Text of one attribute as the schema's type; impossible values give null."""
    name = data_type.typeName()
    if name == "string":
        return text
    if name == "array":
        return F.from_json(text, data_type)
    if name in ("byte", "short", "integer", "long"):
        return F.coalesce(text.try_cast(data_type), text.try_cast("double").try_cast(data_type))
    return text.try_cast(data_type)
