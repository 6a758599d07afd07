"""Read a folder of vector files into one DataFrame."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from featureframe.functions.boxes import box_of
from featureframe.operators.schema import conform, layer_schema
from featureframe.plans.catalog import LayerIdentifier
from featureframe.plans.chunks import id_ranges, place_by_size, place_evenly
from featureframe.session import active_session, settle
from featureframe.sources import geojson, gml, records
from featureframe.sources.archive import unpack_archives
from featureframe.sources.listing import Sources, find_sources, summarise
from featureframe.sources.tasks import (
    CATALOG_SCHEMA,
    describe_attributes,
    describe_layer,
    describe_sources,
    read_ranges,
)
from featureframe.types import OGR_TO_SPARK, ConcurrencyStrategy

TEXT_SOURCES = {"geojson": geojson, "gml": gml}
SPLIT_BYTES = 128 << 20


def read_vector_files(
    path: str,
    ogr_to_spark_type_map: Mapping[tuple[int, int], DataType] = OGR_TO_SPARK,
    pattern: str = "*",
    suffix: str = "*",
    recursive: bool = False,
    ideal_chunk_size: int = 1_000_000,
    geom_field_name: str = "geometry",
    geom_field_type: tuple[int, int] = (8, 0),
    coerce_to_schema: bool = False,
    spark_to_pandas_type_map: Mapping | None = None,
    concurrency_strategy: str = "files",
    vsi_prefix: str | None = None,
    schema: StructType | None = None,
    layer_identifier: LayerIdentifier = None,
    mode: str = "PERMISSIVE",
    spark: SparkSession | None = None,
    split_bytes: int = SPLIT_BYTES,
    bbox: tuple[float, float, float, float] | None = None,
    geometry_type: str = "binary",
    srid: int = 0,
) -> DataFrame:
    """One layer of every matching file as a DataFrame with geometry as WKB.

    Args:
        path: Folder of vector files (GeoPackage, shapefile or folder of shapefiles,
            GeoJSON, GML), on storage every executor can open.
        ogr_to_spark_type_map: (OGR type, subtype) to Spark type, used to infer a schema.
        pattern: File name pattern without extension, with shell wildcards.
        suffix: File extension, with or without the dot.
        recursive: Look into subfolders too.
        ideal_chunk_size: Most rows read by one task under the "rows" strategy.
        geom_field_name: Name of the geometry column, which comes last.
        geom_field_type: Key into the type map for the geometry column.
        coerce_to_schema: Fit every file to the schema: missing columns become
            null, additional ones are left out, values are cast.
        spark_to_pandas_type_map: Accepted for existing calls and not used; Arrow
            carries the types.
        concurrency_strategy: "files" (one task per file; only files above
            ``split_bytes`` are split) or "rows" (one task per chunk of rows).
        vsi_prefix: Archive prefix: "/vsitar/", "/vsizip/" or "/vsigzip/".
        schema: Result schema; also the list of columns that are decoded. Inferred
            from the first readable file by path if not given.
        layer_identifier: Layer name or index; the first layer if not given.
        mode: "PERMISSIVE" passes over files that are no vector data or lack the
            layer, "FAILFAST" fails on them. Other errors fail in both.
        spark: Session to use; the active one if not given.
        split_bytes: Size above which a file is read by several tasks under the
            "files" strategy, and GeoJSON and GML under both. It changes how a file
            is read, never its rows.
        bbox: ``(min_x, min_y, max_x, max_y)`` in the coordinates of the files; only rows
            whose geometry's bounds meet it, edges included. GeoPackages are searched by
            their R-tree if they have one, else by the envelopes before geometries,
            shapefiles by the bounds of the file and of its records, before anything is
            decoded; text files are filtered by what is parsed.
        geometry_type: "binary" (well-known binary) or "geometry", Spark's own type, which
            needs ``spark.sql.geospatial.enabled`` and must be asked for.
        srid: Coordinate system of a "geometry" column, one that Spark knows; 0 for none.
            Coordinates are not changed.
    """
    session = active_session(spark)
    strategy = ConcurrencyStrategy(concurrency_strategy)
    box = box_of(bbox)
    if geometry_type not in ("binary", "geometry"):
        raise ValueError(f"Geometry type {geometry_type!r} is neither 'binary' nor 'geometry'.")
    if isinstance(layer_identifier, int) and layer_identifier < 0:
        raise ValueError(f"Layer index {layer_identifier} is below 0.")

    sources = _sources(path, pattern, suffix, recursive, vsi_prefix, session)
    binary_kinds = sources.kinds - TEXT_SOURCES.keys()
    catalog = None
    if binary_kinds and strategy is ConcurrencyStrategy.ROWS:
        catalog = settle(describe_layer(_binary(sources.names()), layer_identifier, ideal_chunk_size))

    if "geopackage" in sources.kinds and "://" in sources.first[0]:
        raise ValueError("SQLite cannot open GeoPackages by a URI; use a mounted path.")

    inferred = schema is None
    if schema is None or layer_identifier is not None:
        # with a schema too, a layer that no file has is an error and not an empty result
        found = _first_attributes(sources, catalog, layer_identifier)
    if schema is None:
        schema = layer_schema(found, ogr_to_spark_type_map, geom_field_name, geom_field_type)

    frames = []
    if binary_kinds or not sources.kinds:
        frames += [
            read_ranges(
                ranges,
                schema,
                layer_identifier,
                geom_field_name,
                allow_missing=coerce_to_schema,
                allow_additional=coerce_to_schema or not inferred,
                mode=mode,
                box=box,
            )
            for ranges in _plan_ranges(sources, catalog, ideal_chunk_size, layer_identifier, mode, split_bytes)
        ]
    for kind in sorted(sources.kinds & TEXT_SOURCES.keys()):
        found = _text_features(sources, kind, layer_identifier, mode, split_bytes)
        strict = inferred and not coerce_to_schema
        frames.append(TEXT_SOURCES[kind].read(found, schema, geom_field_name, strict, box))
    found = reduce(DataFrame.union, frames) if frames else session.createDataFrame([], schema)
    if geometry_type == "geometry" and geom_field_name in schema.names:
        geometry = F.st_setsrid(F.st_geomfromwkb(F.col(f"`{geom_field_name}`")), srid)
        found = found.withColumn(geom_field_name, geometry)
    return found


def _sources(
    path: str, pattern: str, suffix: str, recursive: bool, vsi_prefix: str | None, session: SparkSession
) -> Sources:
    found = find_sources(path, pattern, suffix, recursive, session, folders=not vsi_prefix)
    return summarise(unpack_archives(found.rows, vsi_prefix, found.count), packed=False) if vsi_prefix else found


def _binary(rows: DataFrame) -> DataFrame:
    """Everything but text files; files no source reads are among them, to be reported or passed over."""
    return rows.filter(~F.coalesce(F.col("source").isin(*TEXT_SOURCES), F.lit(False)))


def describe_layers(
    path: str,
    pattern: str = "*",
    suffix: str = "*",
    recursive: bool = False,
    vsi_prefix: str | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Catalog of the layers of every matching file, with feature counts and attributes."""
    session = active_session(spark)
    sources = _sources(path, pattern, suffix, recursive, vsi_prefix, session)
    frames = [describe_sources(_binary(sources.names()))]
    frames += [_describe_text(sources.names(), kind) for kind in sorted(sources.kinds & TEXT_SOURCES.keys())]
    return reduce(DataFrame.unionByName, frames)


def _plan_ranges(
    sources: Sources,
    catalog: DataFrame | None,
    size: int,
    layer_identifier: LayerIdentifier,
    mode: str,
    split_bytes: int,
) -> list[DataFrame]:
    """Ranges ``(path, source, layer_name, start, stop)`` to read, placed in partitions.

    With a catalog all sources are split; without one, only those above ``split_bytes``.
    """
    if catalog is not None:
        return [place_evenly(id_ranges(_readable(catalog, mode), size))]
    nothing = F.lit(None)
    whole = _placed(sources, _binary(sources.rows).filter(F.col("length") <= split_bytes)).select(
        "path",
        "source",
        nothing.cast("string").alias("layer_name"),
        nothing.cast("bigint").alias("start"),
        nothing.cast("bigint").alias("stop"),
    )
    if sources.largest_bytes <= split_bytes:
        return [whole]
    large = _binary(sources.names()).filter(F.col("length") > split_bytes)
    described = settle(describe_layer(large, layer_identifier, size))
    return [whole, place_evenly(id_ranges(_readable(described, mode), size))]


def _placed(sources: Sources, rows: DataFrame) -> DataFrame:
    """Whole files in the partitions the listing packed them into by size; other rows are dealt out."""
    return rows if sources.packed else place_by_size(rows, sources.total_bytes, sources.count)


def _text_features(
    sources: Sources, kind: str, layer_identifier: LayerIdentifier, mode: str, split_bytes: int
) -> DataFrame:
    """``(path, feature)`` of the layer in all text files of one kind."""
    module = TEXT_SOURCES[kind]
    is_kind = F.col("source") == kind
    small = _placed(sources, sources.rows.filter(is_kind & (F.col("length") <= split_bytes)))
    found = records.whole_files(small, module, layer_identifier, mode)
    if sources.largest_bytes <= split_bytes:
        return found
    large = sources.names().filter(is_kind & (F.col("length") > split_bytes))
    ranges = settle(records.planned(large, module, layer_identifier, split_bytes, mode))
    return found.union(records.ranged(place_evenly(ranges), module))


def _readable(settled: DataFrame, mode: str) -> DataFrame:
    """Rows of files that could be opened; with ``FAILFAST`` any other is an error."""
    if mode == "FAILFAST":
        failed = settled.filter("error is not null").select("path", "error").first()
        if failed is not None:
            raise ValueError(f"{failed['path']} cannot be read: {failed['error']}")
    return settled.filter("error is null")


def _first_attributes(sources: Sources, catalog: DataFrame | None, layer_identifier: LayerIdentifier) -> list:
    """Attributes of the layer in the first file by path that can be opened and has it."""
    if catalog is not None and not sources.kinds & TEXT_SOURCES.keys():
        found = _first_layer_with(sources.names(), sources.kinds, catalog, layer_identifier)
        if found is not None:
            return found
    elif sources.first:
        session = sources.rows.sparkSession
        first = session.createDataFrame([sources.first], "path string, source string")
        found = _first_layer_with(first, {sources.first[1]}, None, layer_identifier)
        if found is not None:
            return found
        found = _first_layer_with(sources.names(), sources.kinds, catalog, layer_identifier)
        if found is not None:
            return found
    wanted = "" if layer_identifier is None else f" with the layer {layer_identifier!r}"
    raise ValueError(f"No file could be opened{wanted}.")


def _first_layer_with(
    sources: DataFrame, kinds: set[str], catalog: DataFrame | None, layer_identifier: LayerIdentifier
) -> list | None:
    options = []
    if kinds - TEXT_SOURCES.keys():
        described = catalog if catalog is not None else describe_attributes(_binary(sources), layer_identifier)
        layers = described.filter("error is null")
        options += layers.orderBy("path").select("path", "attributes").limit(1).collect()
    for kind in kinds & TEXT_SOURCES.keys():
        files = sources.filter(F.col("source") == kind)
        probed = records.found_layers(files, TEXT_SOURCES[kind], layer_identifier).filter("error is null")
        options += probed.orderBy("path").select("path", F.lit(kind).alias("kind")).limit(1).collect()
    if not options:
        return None
    first = min(options, key=lambda row: row["path"])
    if "attributes" in first:
        return first["attributes"]
    module = TEXT_SOURCES[first["kind"]]
    one = sources.filter(F.col("path") == first["path"])
    return module.attributes(records.whole_files(one, module, layer_identifier))


def _describe_text(sources: DataFrame, kind: str) -> DataFrame:
    """Catalog rows of text files, their features counted by one pass."""
    files = sources.filter(F.col("source") == kind)
    found = records.found_layers(files, TEXT_SOURCES[kind], count=True)
    return conform(found.withColumn("source", F.lit(kind)), CATALOG_SCHEMA)
