"""GeoPackage tables, layers, coordinate systems and bounds.

Functions named ``gpkg_*`` work on many files at once and return DataFrames; the
others answer for one file.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import closing

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from featureframe.functions.gpb import FIXED_BYTES, envelope, header_bytes, header_length, split_geometry, wkb_bytes
from featureframe.functions.wkb import wkb_bounds
from featureframe.plans.chunks import id_ranges, place_evenly
from featureframe.session import active_session, settle, ship_package
from featureframe.sources import geopackage
from featureframe.sources.listing import few_partitions
from featureframe.sources.tasks import not_vector_data, read_table
from featureframe.types import sqlite_spark_type, wider_type

RANGE_ROWS = 1_000_000

_COLUMN = StructType([StructField("name", StringType()), StructField("type", StringType())])
_TABLE_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("layer_name", StringType()),
        StructField("columns", ArrayType(_COLUMN)),
        StructField("source", StringType()),
        StructField("first_id", LongType()),
        StructField("last_id", LongType()),
        StructField("range_starts", ArrayType(LongType())),
    ]
)
_CONTENTS = "table_name string, srs_id int, min_x double, min_y double, max_x double, max_y double"
_SRS = "srs_id int, definition string"


def _describe_table(paths: DataFrame, table: str | None, range_rows: int) -> DataFrame:
    """Columns and id bounds of one table, or the first layer, in every file."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_table_row(path, table, range_rows) for path in batch["path"].to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, arrow_schema)

    arrow_schema = to_arrow_schema(_TABLE_SCHEMA)
    ship_package(paths.sparkSession)
    return few_partitions(paths).select("path").mapInArrow(describe, _TABLE_SCHEMA)


def _table_row(path: str, table: str | None, range_rows: int) -> dict:
    if table is None:
        table = next(iter(geopackage.layer_names(path)), None)
        if table is None:
            return {"path": path}
    with closing(geopackage.connect(path)) as db:
        columns = geopackage.declared_columns(db, table)
        if not columns:
            return {"path": path, "layer_name": table}
        first, last = geopackage.id_bounds(db, table)
        counted = geopackage.row_count(db, table) if first is not None and last - first >= range_rows else 0
    types = [{"name": name, "type": sqlite_spark_type(declared)} for name, declared, _ in columns]
    row = {"path": path, "layer_name": table, "columns": types, "source": "geopackage", "first_id": first, "last_id": last}
    if counted and geopackage.is_sparse(counted, first, last):
        row["range_starts"] = geopackage.range_starts(path, table, range_rows)
    return row


def _merged_columns(described: DataFrame) -> list[tuple[str, str]]:
    """Every column any file has, in order of first appearance, with a type that holds all of its files'."""
    columns = described.select("path", F.posexplode("columns").alias("pos", "column"))
    first = F.min(F.struct("path", "pos", "column.name")).alias("first")
    # one row per column name
    found = columns.groupBy(F.lower("column.name").alias("key")).agg(first, F.collect_set("column.type").alias("types"))
    return [(row["first"]["name"], wider_type(row["types"], row["first"]["name"])) for row in found.orderBy("first").collect()]


def _columns_of_first(described: DataFrame, table: str | None) -> list[tuple[str, str]]:
    """The columns of the first file by path; an error where another file has more."""
    first = described.orderBy("path").select("columns").first()["columns"]
    names = [one["name"].lower() for one in first]
    more = F.filter("columns", lambda one: ~F.lower(one["name"]).isin(names))
    other = described.filter(F.size(more) > 0).select("path", more["name"].alias("more")).first()
    if other is not None:
        raise ValueError(f"{other['path']} has more columns: {other['more']}; set merge_schemas=True to read all.")
    return [(one["name"], one["type"]) for one in first]


def _paths(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame([(path,)], "path string")


def read_gpkg_tables(
    paths: DataFrame, table: str | None = None, range_rows: int = RANGE_ROWS, merge_schemas: bool = False
) -> DataFrame:
    """All columns of one table of many GeoPackage or SQLite files, read by rowid ranges.

    Without a ``table`` it is every file's first layer. Columns and types are those of the
    first file by path that has the table; columns a later file lacks are null there, more
    columns are an error, and so is a value that does not fit, of a column that the file
    declares with another type. With ``merge_schemas`` the result has the columns of all
    files, each of a type that holds what any of them declares, so nothing is lost.
    """
    described = settle(_describe_table(paths, table, range_rows)).filter("columns is not null")
    if described.isEmpty():
        raise ValueError("No file has a layer." if table is None else f"No file has a table {table}.")
    columns = _merged_columns(described) if merge_schemas else _columns_of_first(described, table)
    schema = StructType.fromDDL(", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in columns))
    return read_table(place_evenly(id_ranges(described, range_rows)), schema)


def read_gpkg_table(
    path: str, table: str, spark: SparkSession | None = None, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """All columns of one table of one GeoPackage or SQLite file."""
    return read_gpkg_tables(_paths(active_session(spark), path), table, range_rows)


def _small_table(paths: DataFrame, table: str, ddl: str) -> DataFrame:
    """``path`` and chosen columns of a metadata table of every file; unreadable files give no rows."""
    schema = StructType([StructField("path", StringType()), *StructType.fromDDL(ddl).fields])
    names = schema.names[1:]
    types = [pa.string(), *(_ARROW[field.dataType.simpleString()] for field in schema.fields[1:])]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                try:
                    found = list(geopackage.fetch(path, table, names, None, None))
                except Exception as error:
                    if not_vector_data(error):
                        continue
                    raise
                for count, values in found:
                    arrays = [pa.array(column, kind) for column, kind in zip([[path] * count, *values], types)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    ship_package(paths.sparkSession)
    return few_partitions(paths).select("path").mapInArrow(read, schema)


_ARROW = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}


def gpkg_contents(paths: DataFrame) -> DataFrame:
    """``(path, table_name, srs_id, min_x, min_y, max_x, max_y)`` of every layer of every file."""
    return _small_table(paths, "gpkg_contents", _CONTENTS)


def gpkg_crs(paths: DataFrame) -> DataFrame:
    """``(path, layer_name, srs_id, definition)`` of every layer of every file.

    Both tables are in the same file, so each file joins its own.
    """
    tables = ("gpkg_contents", "gpkg_spatial_ref_sys")
    query = (
        "select c.table_name, c.srs_id, s.definition from gpkg_contents c"
        " join gpkg_spatial_ref_sys s on s.srs_id = c.srs_id order by c.rowid"
    )
    schema = StructType.fromDDL("path string, layer_name string, srs_id int, definition string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                try:
                    rows = geopackage.answers(path, query, tables)
                except Exception as error:
                    if not_vector_data(error):
                        continue
                    raise
                columns = list(zip(*((path, *row) for row in rows)))
                if columns:
                    kinds = (pa.string(), pa.string(), pa.int32(), pa.string())
                    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    ship_package(paths.sparkSession)
    return few_partitions(paths).select("path").mapInArrow(read, schema)


def gpkg_bounds(paths: DataFrame) -> DataFrame:
    """``(path, layer_name, min_x, min_y, max_x, max_y)`` as stored in every file."""
    return gpkg_contents(paths).select(
        "path", F.col("table_name").alias("layer_name"), "min_x", "min_y", "max_x", "max_y"
    )


def computed_bounds(df: DataFrame, keys: list[str], geometry_column: str = "geom") -> DataFrame:
    """Bounds of the GPB geometries of each group, from the header or, without one, the WKB.

    Minimum and maximum combine before the shuffle, so a group of any size is a
    handful of rows per task.
    """
    blob = F.col(f"`{geometry_column}`")
    # geometries whose header has an envelope are not sent to Python
    bare = F.when(header_length(blob) == FIXED_BYTES, wkb_bytes(blob))
    box = F.coalesce(envelope(header_bytes(blob)), wkb_bounds(bare))
    boxes = df.select(*keys, box.alias("_box"))
    # an empty geometry may have corners that are no numbers
    corners = [F.nanvl(F.col("_box").getItem(i), F.lit(None).cast("double")) for i in range(4)]
    return boxes.groupBy(*keys).agg(
        F.min(corners[0]).alias("min_x"),
        F.min(corners[2]).alias("min_y"),
        F.max(corners[1]).alias("max_x"),
        F.max(corners[3]).alias("max_y"),
    )


def list_layers(path: str, spark: SparkSession | None = None) -> list[str]:
    """Names of the layers in a GeoPackage."""
    contents = gpkg_contents(_paths(active_session(spark), path))
    return [row["table_name"] for row in contents.select("table_name").collect()]


def _one_layer(rows: list, path: str, layer_name: str, spark: SparkSession | None) -> tuple:
    if not rows:
        raise ValueError(f"{path} has no layer {layer_name!r}, only {list_layers(path, spark)}.")
    return rows[0]


def get_crs(path: str, layer_name: str, spark: SparkSession | None = None) -> str:
    """Well-known text of the coordinate reference system of a layer."""
    layer = F.col("layer_name") == layer_name
    rows = gpkg_crs(_paths(active_session(spark), path)).filter(layer).select("definition").collect()
    return _one_layer(rows, path, layer_name, spark)["definition"]


def get_bounds(path: str, layer_name: str, spark: SparkSession | None = None) -> tuple[float, ...]:
    """``(min_x, min_y, max_x, max_y)`` of a layer as stored in the GeoPackage."""
    layer = F.col("layer_name") == layer_name
    bounds = gpkg_bounds(_paths(active_session(spark), path)).filter(layer)
    rows = bounds.select("min_x", "min_y", "max_x", "max_y").collect()
    return tuple(_one_layer(rows, path, layer_name, spark))


def read_gpkg(
    path: str,
    original_geometry_column_name: str = "geom",
    header_length: int | None = None,
    drop_gpb_header: bool = False,
    layer_name: str | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """A GeoPackage layer with its geometry split into ``gpb_header`` and ``wkb_geometry``.

    Args:
        path: The GeoPackage, on a path every executor can open.
        original_geometry_column_name: Geometry column of the layer.
        header_length: Header bytes of every geometry (40, 56 or 72); taken from
            each header's own flags if not given.
        drop_gpb_header: Leave ``gpb_header`` out.
        layer_name: Layer to read; the first one if not given.
        spark: Session to use; the active one if not given.
    """
    paths = _paths(active_session(spark), path)
    return read_gpkg_files(paths, original_geometry_column_name, header_length, drop_gpb_header, layer_name)


def read_gpkg_files(
    paths: DataFrame,
    original_geometry_column_name: str = "geom",
    header_length: int | None = None,
    drop_gpb_header: bool = False,
    layer_name: str | None = None,
    merge_schemas: bool = False,
) -> DataFrame:
    """As :func:`read_gpkg` for every file of ``paths`` (``path``) in one read, by the rules of :func:`read_gpkg_tables`.

    Without a ``layer_name`` it is the first layer of each file.
    """
    table = read_gpkg_tables(paths, layer_name, merge_schemas=merge_schemas)
    return split_geometry(table, original_geometry_column_name, header_length, drop_gpb_header)
