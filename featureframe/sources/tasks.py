"""What runs in tasks: describe layers and read row ranges.

Both take a DataFrame of sources or ranges and are one ``mapInArrow`` each, so
Spark decides where every file or range is read.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator
from contextlib import closing
from types import ModuleType

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from featureframe.functions.boxes import Box
from featureframe.operators.fit import fit
from featureframe.plans.catalog import LayerIdentifier
from featureframe.sources import geopackage, shapefile
from featureframe.sources.layers import Attribute, Layer, NotVectorData, Rows
from featureframe.types import OGR_TO_SPARK, sqlite_spark_type

RANGE_READERS: dict[str, ModuleType] = {"geopackage": geopackage, "shapefile": shapefile}


def not_vector_data(error: Exception) -> bool:
    """Whether an error says that the file at a path is no readable source."""
    return isinstance(error, NotVectorData) or geopackage.is_damaged(error)


ATTRIBUTE_TYPE = StructType(
    [
        StructField("name", StringType()),
        StructField("ogr_type", IntegerType()),
        StructField("ogr_subtype", IntegerType()),
    ]
)
CATALOG_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("source", StringType()),
        StructField("layer_index", IntegerType()),
        StructField("layer_name", StringType()),
        StructField("feature_count", LongType()),
        StructField("first_id", LongType()),
        StructField("last_id", LongType()),
        StructField("range_starts", ArrayType(LongType())),
        StructField("attributes", ArrayType(ATTRIBUTE_TYPE)),
        StructField("error", StringType()),
    ]
)


def resolve_layer(names: list[str], identifier: LayerIdentifier) -> str:
    """The named layer, the layer at an index, or the first layer."""
    if isinstance(identifier, str):
        if identifier not in names:
            raise NotVectorData(f"There is no layer {identifier!r}, only {names}.")
        return identifier
    index = 0 if identifier is None else identifier
    if not 0 <= index < len(names):
        raise NotVectorData(f"Layer index {index} is outside 0 to {len(names) - 1}.")
    return names[index]


def describe_sources(sources: DataFrame, range_rows: int | None = None) -> DataFrame:
    """One catalog row per layer of every source; one row with an error per unreadable source."""

    def find(path: str, reader: ModuleType) -> list[dict]:
        names = enumerate(reader.layer_names(path))
        return [_layer_row(path, index, reader.describe(path, name), range_rows) for index, name in names]

    return _catalog(sources, find)


def describe_layer(sources: DataFrame, layer_identifier: LayerIdentifier, range_rows: int) -> DataFrame:
    """One catalog row per source for the layer to read, without a look at the others.

    Layers with sparse ids get the ids that ranges of ``range_rows`` rows start at.
    """

    def find(path: str, reader: ModuleType) -> list[dict]:
        names = reader.layer_names(path)
        name = resolve_layer(names, layer_identifier)
        return [_layer_row(path, names.index(name), reader.describe(path, name), range_rows)]

    return _catalog(sources, find)


def describe_attributes(sources: DataFrame, layer_identifier: LayerIdentifier) -> DataFrame:
    """As :func:`describe_layer` with the attributes only, which needs no count of features."""

    def find(path: str, reader: ModuleType) -> list[dict]:
        name = resolve_layer(reader.layer_names(path), layer_identifier)
        return [{"layer_name": name, "attributes": [a._asdict() for a in reader.attributes(path, name)]}]

    return _catalog(sources, find)


def _layer_row(path: str, index: int, layer: Layer, range_rows: int | None) -> dict:
    starts = None
    if range_rows and geopackage.is_sparse(layer.feature_count, layer.first_id, layer.last_id):
        starts = geopackage.range_starts(path, layer.name, range_rows)
    return {
        "layer_index": index,
        "layer_name": layer.name,
        "feature_count": layer.feature_count,
        "first_id": layer.first_id,
        "last_id": layer.last_id,
        "range_starts": starts,
        "attributes": [attribute._asdict() for attribute in layer.attributes],
    }


def _catalog(sources: DataFrame, find: Callable[[str, ModuleType], list[dict]]) -> DataFrame:
    arrow_schema = to_arrow_schema(CATALOG_SCHEMA)

    def rows(path: str, source: str | None) -> list[dict]:
        reader = RANGE_READERS.get(source)
        if reader is None:
            return [{"error": "No source reads this file."}]
        try:
            return find(path, reader)
        except Exception as error:
            if not_vector_data(error):
                return [{"error": str(error) or type(error).__name__}]
            raise

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, source in zip(batch["path"].to_pylist(), batch["source"].to_pylist()):
                found = [{"path": path, "source": source, **row} for row in rows(path, source)]
                yield pa.RecordBatch.from_pylist(found, arrow_schema)

    return sources.select("path", "source").mapInArrow(describe, CATALOG_SCHEMA)


def read_ranges(
    ranges: DataFrame,
    schema: StructType,
    layer_identifier: LayerIdentifier = None,
    geom_field_name: str = "geometry",
    allow_missing: bool = False,
    allow_additional: bool = False,
    mode: str = "PERMISSIVE",
    box: Box | None = None,
) -> DataFrame:
    """Rows of every ``(path, source, layer_name, start, stop)``, with a ``box`` those whose geometry's bounds meet it.

    A null ``layer_name`` is resolved from ``layer_identifier`` when the file is
    opened. Only attributes in ``schema`` are decoded. A file that is no vector data
    or has no such layer gives no rows, or fails with ``mode="FAILFAST"``. Unless
    columns may be missing, a value of a column of another type that does not fit the
    schema's is an error too.
    """
    arrow_schema = to_arrow_schema(schema)
    wanted = [name for name in schema.names if name != geom_field_name]

    def check(path: str, attributes: list[Attribute]) -> None:
        names = [attribute.name for attribute in attributes]
        missing = [name for name in wanted if name not in names]
        additional = [name for name in names if name not in wanted]
        if (missing and not allow_missing) or (additional and not allow_additional):
            raise RuntimeError(
                f"{path} does not fit the schema (missing: {missing}, additional: {additional}); "
                "set coerce_to_schema=True to fit it."
            )

    def unlike(attributes: list[Attribute]) -> set[str]:
        """Columns that have another type in this file than in the schema."""
        own = {one.name: OGR_TO_SPARK.get((one.ogr_type, one.ogr_subtype)) for one in attributes}
        return {name for name in wanted if name in own and own[name] != schema[name].dataType}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader, path, name = RANGE_READERS.get(row["source"]), row["path"], row["layer_name"]
                try:
                    if reader is None:
                        raise NotVectorData(f"No source reads {path}.")
                    layer = resolve_layer(reader.layer_names(path), layer_identifier if name is None else name)
                    attributes = reader.attributes(path, layer)
                except Exception as error:
                    if mode == "FAILFAST" or not not_vector_data(error):
                        raise
                    continue
                check(path, attributes)
                strict = set() if allow_missing else unlike(attributes)
                for rows in reader.batches(path, layer, row["start"], row["stop"], wanted, box):
                    yield _fitted(rows, arrow_schema, geom_field_name, path, strict)

    columns = ["path", "source", "layer_name", "start", "stop"]
    return ranges.select(*columns).mapInArrow(read, schema)


def _fitted(
    rows: Rows,
    schema: pa.Schema,
    geom_field_name: str,
    path: str = "",
    strict: Collection[str] = (),
    way_out: str = "coerce_to_schema",
) -> pa.RecordBatch:
    """Rows in the schema's types; no value of the columns in ``strict`` may get lost by that."""
    arrays = []
    for field in schema:
        values = rows.geometry if field.name == geom_field_name else rows.columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(rows.count, field.type))
            continue
        arrays.append(fit(values, field.type))
        lost = field.name in strict and (arrays[-1].null_count > _null_count(values) or _rounded(values, field.type))
        if lost:
            raise RuntimeError(f"{path} has values of {field.name} that are no {field.type}; set {way_out}=True to fit it.")
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _rounded(values: pa.Array | list, target: pa.DataType) -> bool:
    """Whether integers become other numbers in a floating type."""
    if not pa.types.is_floating(target) or not isinstance(values, list):
        return False
    return any(type(value) is int and int(float(value)) != value for value in values)


def _null_count(values: pa.Array | list) -> int:
    return values.count(None) if isinstance(values, list) else values.null_count


def read_table(ranges: DataFrame, schema: StructType) -> DataFrame:
    """Columns of SQLite tables over ``(path, layer_name, start, stop)`` rowid ranges, as stored.

    A value that does not fit is an error where the file declares another type than the schema's.
    """
    arrow_schema = to_arrow_schema(schema)

    def unlike(path: str, table: str) -> set[str]:
        with closing(geopackage.connect(path)) as db:
            own = {name.lower(): sqlite_spark_type(declared) for name, declared, _ in geopackage.declared_columns(db, table)}
        kinds = {field.name: field.dataType.simpleString() for field in schema}
        return {name for name, kind in kinds.items() if own.get(name.lower(), kind) != kind}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                path, table = row["path"], row["layer_name"]
                strict = unlike(path, table)
                for count, values in geopackage.fetch(path, table, schema.names, row["start"], row["stop"]):
                    columns = dict(zip(schema.names, values))
                    yield _fitted(Rows(count, columns, None), arrow_schema, "", path, strict, "merge_schemas")

    return ranges.select("path", "layer_name", "start", "stop").mapInArrow(read, schema)
