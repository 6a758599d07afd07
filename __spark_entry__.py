"""

Round-trip queries first write a given table as a folder of vector files below the
shared folder (``featureframe.testing.encode``), once per session, then read that
folder with the operator under test and return the rows it gives.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import partial, reduce
from types import ModuleType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from featureframe import describe_layers, read_vector_files
from featureframe.functions import gpb
from featureframe.functions.wkb import point_wkb, wkb_bounds, wkb_xy
from featureframe.gpkg import computed_bounds, gpkg_bounds, gpkg_contents, gpkg_crs, read_gpkg_files, read_gpkg_tables
from featureframe.operators.schema import (
    add_missing_columns,
    conform,
    drop_additional_columns,
    union_conformed,
)
from featureframe.plans.catalog import feature_counts, skipped_files
from featureframe.plans.chunks import id_ranges, with_dense_id
from featureframe.session import new_shared_folder, settle, ship_package
from featureframe.sources.listing import archive_paths, base_name, find_sources, list_files, parent
from featureframe.sources.tasks import describe_sources
from featureframe.testing.encode import gpb_boxed_points, gpb_points, write_vector_files
from featureframe.types import declared_type_column, ogr_type_column

PART_ROWS = 1000
FLAT_PART_ROWS = 3000
EVENT_FILE_ROWS = 5000
ORDER_FILE_ROWS = 20_000
CHUNK_OF_LAYER = 250

_folders: dict[tuple[str, str, str], str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part(key: str, rows: int) -> Column:
    return F.expr(f"{key} div {rows}").cast("string")


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Folder of the named files, written the first time a session asks for it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _folders:
        folder = new_shared_folder(spark, name)
        write(folder)
        _folders[key] = folder
    return _folders[key]


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("layer"),
        F.col("c_custkey").alias("fid"),
        F.col("c_acctbal").alias("x"),
        F.col("c_custkey").cast("double").alias("y"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("category"),
    )


def _customer_files(spark: SparkSession, sf_dir: str, kind: str, extension: str) -> str:
    """One file per segment and ``FLAT_PART_ROWS`` keys, flat."""

    def write(folder: str) -> None:
        name = F.concat("layer", F.lit("_"), _part("id", FLAT_PART_ROWS), F.lit(f".{extension}"))
        write_vector_files(_customers(spark, sf_dir).withColumn("file", name), folder, kind)

    return _once(spark, sf_dir, f"customer-{kind}-{extension}", write)


def _nested_customer_files(spark: SparkSession, sf_dir: str) -> str:
    """GeoPackages in one subfolder per segment; feature ids have wide gaps."""

    def write(folder: str) -> None:
        name = F.concat("layer", F.lit("/part_"), _part("id", FLAT_PART_ROWS), F.lit(".gpkg"))
        sparse = _customers(spark, sf_dir).withColumn("file", name).withColumn("fid", F.col("id") * 1000 + 3)
        write_vector_files(sparse, folder, "geopackage")

    return _once(spark, sf_dir, "customer-nested", write)


def _layered_customer_files(spark: SparkSession, sf_dir: str) -> str:
    """GeoPackages with one layer per segment, each with a nation as coordinate system."""

    def write(folder: str) -> None:
        name = F.concat(F.lit("part_"), _part("c_custkey", PART_ROWS), F.lit(".gpkg"))
        customer = _table(spark, sf_dir, "customer").withColumn("file", name)
        systems = (
            customer.groupBy("file", "c_mktsegment")
            .agg(F.min("c_nationkey").alias("n_nationkey"))
            .join(_table(spark, sf_dir, "nation"), "n_nationkey")
            .withColumnsRenamed({"c_mktsegment": "layer", "n_nationkey": "srs_id", "n_name": "definition"})
            .select("file", "layer", "srs_id", "definition")
        )
        name = F.concat(F.lit("part_"), _part("id", PART_ROWS), F.lit(".gpkg"))
        rows = _customers(spark, sf_dir).withColumn("file", name)
        write_vector_files(rows.join(systems, ["file", "layer"]), folder, "geopackage")

    return _once(spark, sf_dir, "customer-layered", write)


def _folder_customer_files(spark: SparkSession, sf_dir: str) -> str:
    """Folders of shapefiles, one layer per segment."""

    def write(folder: str) -> None:
        name = F.concat(F.lit("part_"), _part("id", PART_ROWS), F.lit(".gdb"))
        write_vector_files(_customers(spark, sf_dir).withColumn("file", name), folder, "shapefile")

    return _once(spark, sf_dir, "customer-folders", write)


def _archive_files(spark: SparkSession, sf_dir: str) -> str:
    def write(folder: str) -> None:
        name = F.concat("layer", F.lit("_"), _part("id", FLAT_PART_ROWS), F.lit(".tar.gz"))
        write_vector_files(_customers(spark, sf_dir).withColumn("file", name), folder, "archive")

    return _once(spark, sf_dir, "customer-archive", write)


def _null_shape_files(spark: SparkSession, sf_dir: str) -> str:
    def write(folder: str) -> None:
        name = F.concat(F.lit("part_"), _part("id", PART_ROWS), F.lit(".shp"))
        rows = _customers(spark, sf_dir).withColumn("layer", F.lit("points")).withColumn("file", name)
        write_vector_files(rows.withColumn("x", F.when(F.col("x") >= 0, F.col("x"))), folder, "shapefile")

    return _once(spark, sf_dir, "customer-null", write)


def _supplier_files(spark: SparkSession, sf_dir: str) -> str:
    """Supplier GeoPackages beside one file that is none."""

    def write(folder: str) -> None:
        rows = _table(spark, sf_dir, "supplier").select(
            F.concat(F.lit("supplier_"), _part("s_suppkey", 50), F.lit(".gpkg")).alias("file"),
            F.lit("supplier").alias("layer"),
            F.col("s_suppkey").alias("fid"),
            F.col("s_acctbal").alias("x"),
            F.col("s_suppkey").cast("double").alias("y"),
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("category"),
            F.col("s_acctbal").alias("balance"),
        )
        write_vector_files(rows, folder, "geopackage")
        with open(f"{folder}/broken.gpkg", "wb") as file:
            file.write(b"not a database" * 100)

    return _once(spark, sf_dir, "supplier", write)


def _mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """Files ``(id, category)`` beside files of customers in debt, with their balance and the id as text."""

    def write(folder: str) -> None:
        customers = _customers(spark, sf_dir)
        name = F.concat(F.lit("a_"), _part("id", PART_ROWS), F.lit(".gpkg"))
        layer = F.lit("points")
        owed = customers.filter("x >= 0").withColumn("layer", layer).withColumn("file", name)
        write_vector_files(owed, folder, "geopackage")
        name = F.concat(F.lit("b_"), _part("id", PART_ROWS), F.lit(".gpkg"))
        owing = customers.filter("x < 0").withColumn("layer", layer).withColumn("file", name)
        owing = owing.withColumn("id", F.col("id").cast("string")).withColumn("balance", F.col("x"))
        write_vector_files(owing, folder, "geopackage")

    return _once(spark, sf_dir, "customer-mixed", write)


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """GeoPackages with one layer per event type."""

    def write(folder: str) -> None:
        rows = _table(spark, sf_dir, "events").select(
            F.concat(F.lit("events_"), _part("event_id", EVENT_FILE_ROWS), F.lit(".gpkg")).alias("file"),
            F.col("event_type").alias("layer"),
            F.col("event_id").alias("fid"),
            F.col("value").alias("x"),
            F.col("user_id").cast("double").alias("y"),
            "event_id",
            "user_id",
        )
        write_vector_files(rows, folder, "geopackage")

    return _once(spark, sf_dir, "events", write)


def _order_files(spark: SparkSession, sf_dir: str) -> str:
    def write(folder: str) -> None:
        rows = _table(spark, sf_dir, "orders").select(
            F.concat(F.lit("orders_"), _part("o_orderkey", ORDER_FILE_ROWS), F.lit(".gpkg")).alias("file"),
            F.lit("orders").alias("layer"),
            F.col("o_orderkey").alias("fid"),
            F.col("o_totalprice").alias("x"),
            F.col("o_custkey").cast("double").alias("y"),
            F.col("o_orderkey").alias("id"),
            F.col("o_orderpriority").alias("category"),
        )
        write_vector_files(rows, folder, "geopackage")

    return _once(spark, sf_dir, "orders", write)


def _gpb_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a GPB point of (total price, customer key)."""
    y = F.col("o_custkey").cast("double")
    return _table(spark, sf_dir, "orders").select("o_orderkey", gpb_boxed_points("o_totalprice", y).alias("geom"))


def _with_xy(df: DataFrame) -> DataFrame:
    return df.withColumn("p", wkb_xy("geometry")).select("id", "category", "p.x", "p.y")


def _file_name() -> Column:
    return base_name(F.col("path")).alias("file_name")


# --- sources ---------------------------------------------------------------


def q_list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _customer_files(spark, sf_dir, "shapefile", "shp")
    return list_files(folder, "BUILDING*", ".shp", spark=spark).select(_file_name())


def q_list_files_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(_nested_customer_files(spark, sf_dir), suffix="gpkg", recursive=True, spark=spark)
    return files.groupBy(base_name(parent(F.col("path"))).alias("folder")).agg(F.count("*").alias("files"))


def q_archive_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return archive_paths(pages, "/vsigzip/", "url", "vsi_path").select("page_id", "vsi_path")


def q_read_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _archive_files(spark, sf_dir)
    return _with_xy(read_vector_files(folder, suffix=".gz", vsi_prefix="/vsitar/", spark=spark))


def _zip_files(spark: SparkSession, sf_dir: str) -> str:
    """Zip archives that each hold the shapefiles of all segments, in folders."""

    def write(folder: str) -> None:
        name = F.concat(F.lit("part_"), _part("id", FLAT_PART_ROWS), F.lit(".zip"))
        write_vector_files(_customers(spark, sf_dir).withColumn("file", name), folder, "zip")

    return _once(spark, sf_dir, "customer-zip", write)


def q_read_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_xy(read_vector_files(_zip_files(spark, sf_dir), suffix="zip", vsi_prefix="/vsizip/", spark=spark))


def q_layer_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = describe_layers(_event_files(spark, sf_dir), suffix="gpkg", spark=spark)
    return catalog.select(_file_name(), "layer_index", "layer_name", "feature_count")


def _events_layer(spark: SparkSession, sf_dir: str, layer: str | int | None) -> DataFrame:
    events = read_vector_files(_event_files(spark, sf_dir), suffix="gpkg", layer_identifier=layer, spark=spark)
    return events.select("event_id", "user_id")


def q_layer_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_layer(spark, sf_dir, "click")


def q_layer_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_layer(spark, sf_dir, 1)


def q_first_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_layer(spark, sf_dir, None)


def q_feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = feature_counts(describe_layers(_event_files(spark, sf_dir), suffix="gpkg", spark=spark))
    return counts.groupBy("layer_name").agg(F.sum("feature_count").alias("feature_count"))


def _event_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges a read of all layers of the event files is cut into."""
    sources = find_sources(_event_files(spark, sf_dir), suffix="gpkg", spark=spark)
    return id_ranges(settle(describe_sources(sources.names(), CHUNK_OF_LAYER)), CHUNK_OF_LAYER)


def q_plan_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_ranges(spark, sf_dir).select(_file_name(), "layer_name", "start", "stop")


def q_total_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_ranges(spark, sf_dir).agg(F.count("*").alias("total_chunks"))


def q_chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = settle(_event_ranges(spark, sf_dir).orderBy("path", "layer_name", "start"))
    return with_dense_id(ordered, "id").select(_file_name(), "layer_name", "id", "start", "stop")


def q_read_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_xy(read_vector_files(_order_files(spark, sf_dir), suffix=".gpkg", spark=spark))


def q_read_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_vector_files(
        _order_files(spark, sf_dir), suffix=".gpkg", concurrency_strategy="rows", ideal_chunk_size=7000, spark=spark
    )
    return _with_xy(orders)


def q_read_rows_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _nested_customer_files(spark, sf_dir)
    return _with_xy(
        read_vector_files(
            folder, suffix="gpkg", recursive=True, concurrency_strategy="rows", ideal_chunk_size=250, spark=spark
        )
    )


def q_read_shapefile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _customer_files(spark, sf_dir, "shapefile", "shp")
    return _with_xy(read_vector_files(folder, suffix=".shp", spark=spark))


def q_read_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as Spark's geometry type, and back."""
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    folder = _customer_files(spark, sf_dir, "shapefile", "shp")
    points = read_vector_files(folder, suffix="shp", geometry_type="geometry", srid=3857, spark=spark)
    point = wkb_xy(F.st_asbinary("geometry")).alias("p")
    return points.select("id", F.st_srid("geometry").alias("srid"), point).select("id", "srid", "p.x", "p.y")


def q_read_shapefile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _customer_files(spark, sf_dir, "shapefile", "shp")
    return _with_xy(
        read_vector_files(folder, suffix=".shp", concurrency_strategy="rows", ideal_chunk_size=250, spark=spark)
    )


def q_read_shapefile_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder_customer_files(spark, sf_dir)
    return _with_xy(read_vector_files(folder, suffix=".gdb", layer_identifier="MACHINERY", spark=spark))


def q_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType.fromDDL("id bigint, category string, geometry binary")
    folder = _customer_files(spark, sf_dir, "geojson", "geojson")
    return _with_xy(read_vector_files(folder, suffix="geojson", schema=schema, spark=spark))


def _geojson_variant(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    schema = StructType.fromDDL("id bigint, category string, geometry binary")
    folder = _customer_files(spark, sf_dir, kind, "geojson")
    return _with_xy(read_vector_files(folder, suffix="geojson", schema=schema, spark=spark))


def q_geojson_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geojson_variant(spark, sf_dir, "geojson-lines")


def q_geojson_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geojson_variant(spark, sf_dir, "geojson-sequence")


def q_geojson_nested_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geojson_variant(spark, sf_dir, "geojson-nested")


#: Formats of shapes, with their file extension.
_SHAPE_KINDS = (("geopackage", "gpkg"), ("shapefile", "shp"), ("geojson", "geojson"))


def _shapes(
    spark: SparkSession,
    sf_dir: str,
    shape: Column,
    label: str,
    kinds: tuple[tuple[str, str], ...] = _SHAPE_KINDS,
    bbox: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Length and bounds of the customers' shapes, from GeoPackages, shapefiles and GeoJSON in turn."""
    customers = _customers(spark, sf_dir).withColumn("layer", F.lit("shapes")).withColumn("shape", shape)
    frames = []
    for at, (kind, extension) in enumerate(kinds):

        def write(folder: str) -> None:
            name = F.concat(F.lit("part_"), _part("id", PART_ROWS), F.lit(f".{extension}"))
            own = customers.filter(F.col("id") % len(kinds) == at)
            write_vector_files(own.select("layer", "fid", "x", "y", "shape", "id", name.alias("file")), folder, kind)

        schema = StructType.fromDDL("id bigint, geometry binary")
        folder = _once(spark, sf_dir, f"{label}-{kind}", write)
        frames.append(read_vector_files(folder, suffix=extension, schema=schema, spark=spark, bbox=bbox))
    box = wkb_bounds(F.col("geometry"))
    corners = [F.col("box").getItem(i).alias(name) for i, name in enumerate(("min_x", "max_x", "min_y", "max_y"))]
    rows = reduce(DataFrame.unionByName, frames).select("id", F.length("geometry").alias("bytes"), box.alias("box"))
    return rows.select("id", "bytes", *corners)


def q_read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices = F.concat(F.lit("line:"), (2 + F.col("id") % 4).cast("string"))
    return _shapes(spark, sf_dir, vertices, "customer-lines")


def q_read_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shapes(spark, sf_dir, F.lit("polygon"), "customer-polygons")


def q_gml_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shapes(spark, sf_dir, F.lit("polygon"), "customer-polygons-all", (("gml", "gml"),))


#: The box of the query, in the customers' coordinates
_BBOX = (-100.0, 100.0, 4000.0, 1200.0)


def q_read_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' polygons near a box, a fifth of them in each format."""
    kinds = (("geopackage", "gpkg"), ("geopackage-indexed", "gpkg"), *_SHAPE_KINDS[1:], ("gml", "gml"))
    return _shapes(spark, sf_dir, F.lit("polygon"), "customer-boxed", kinds, _BBOX)


def q_gml(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType.fromDDL("id bigint, category string, geometry binary")
    folder = _customer_files(spark, sf_dir, "gml", "gml")
    return _with_xy(read_vector_files(folder, suffix="gml", schema=schema, spark=spark))


def q_wkb_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    point = point_wkb("o_totalprice", F.col("o_custkey").cast("double"))
    return orders.select(F.col("o_orderkey").alias("id"), wkb_xy(point).alias("p")).select("id", "p.x", "p.y")


def q_null_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = read_vector_files(_null_shape_files(spark, sf_dir), suffix="shp", spark=spark)
    return points.select("id", F.col("geometry").isNull().alias("is_null"))


def q_tolerant_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = read_vector_files(_supplier_files(spark, sf_dir), suffix="gpkg", spark=spark)
    return suppliers.select("id", "category", "balance")


def q_skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = describe_layers(_supplier_files(spark, sf_dir), suffix="gpkg", spark=spark)
    skipped = skipped_files(catalog).select(_file_name(), F.lit(None).cast("bigint").alias("features"))
    read = feature_counts(catalog).select(_file_name(), F.col("feature_count").alias("features"))
    return skipped.unionByName(read)


# --- schema ----------------------------------------------------------------


def q_read_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, name and type of every column of a read, as its rows have them."""
    rows = read_vector_files(_customer_files(spark, sf_dir, "shapefile", "shp"), suffix="shp", spark=spark)
    columns = [
        F.struct(F.lit(at).alias("pos"), F.lit(name).alias("name"), F.typeof(name).alias("spark_type"))
        for at, name in enumerate(rows.columns)
    ]
    return rows.select(F.inline(F.array(*columns))).groupBy("pos", "name", "spark_type").agg(F.count("*").alias("n"))


def q_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _customer_files(spark, sf_dir, "shapefile", "shp")
    catalog = describe_layers(folder, suffix="shp", spark=spark)
    return catalog.select(_file_name(), F.posexplode("attributes").alias("pos", "a")).select(
        "file_name", "pos", "a.name", ogr_type_column(F.col("a.ogr_type"), F.col("a.ogr_subtype")).alias("spark_type")
    )


def q_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    ogr_type, ogr_subtype = F.col("l_partkey") % 14, F.col("l_suppkey") % 6
    spark_type = ogr_type_column(ogr_type, ogr_subtype)
    return (
        _table(spark, sf_dir, "lineitem")
        .groupBy(spark_type.alias("spark_type"))
        .agg(F.count("*").alias("fields"))
    )


# Declared types with and without a size
_DECLARED = (
    "BOOLEAN TINYINT SMALLINT MEDIUMINT INT INTEGER FLOAT DOUBLE REAL TEXT TEXT(20) BLOB BLOB(9)"
    " POINT MULTIPOLYGON DATE DATETIME NUMERIC"
).split()


def q_gpkg_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(name) for name in _DECLARED])
    declared = F.get(names, (F.col("l_partkey") % len(_DECLARED)).cast("int"))
    lineitem = _table(spark, sf_dir, "lineitem").select(declared.alias("declared_type"))
    spark_type = declared_type_column(F.col("declared_type")).alias("spark_type")
    return lineitem.groupBy("declared_type", spark_type).agg(F.count("*").alias("fields"))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("category"))


def q_conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType.fromDDL("id string, category string, missing_long bigint")
    return conform(_suppliers(spark, sf_dir), schema)


def q_add_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType.fromDDL("id bigint, m_int int, m_bool boolean")
    return add_missing_columns(_suppliers(spark, sf_dir).select("id"), schema)


def q_drop_additional(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": "id", "c_mktsegment": "category"})
    return drop_additional_columns(customer, StructType.fromDDL("id bigint, category string"))


def q_union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType.fromDDL("id bigint, category string, bal double")
    customer = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("category"), F.col("c_acctbal").alias("bal")
    )
    return union_conformed([customer, _suppliers(spark, sf_dir)], schema)


def q_coerce_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType.fromDDL("id bigint, category string, balance double, flag boolean")
    folder = _mixed_files(spark, sf_dir)
    return read_vector_files(folder, suffix="gpkg", schema=schema, coerce_to_schema=True, spark=spark)


def q_user_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType([StructField("id", LongType()), StructField("category", StringType())])
    return read_vector_files(_order_files(spark, sf_dir), suffix="gpkg", schema=schema, spark=spark)


# --- GeoPackage ------------------------------------------------------------


def _layer_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of customers; those in debt come in files of their own, without the balance."""

    def write(folder: str) -> None:
        rows = _customers(spark, sf_dir).withColumn("layer", F.lit("points"))
        for name, kept in (("a_", "x >= 0"), ("b_", "x < 0")):
            own = rows.filter(kept).withColumn("file", F.concat(F.lit(name), _part("id", PART_ROWS), F.lit(".gpkg")))
            write_vector_files(own.withColumn("balance", F.col("x")) if name == "a_" else own, folder, "geopackage")

    return _once(spark, sf_dir, "customer-columns", write)


def q_read_gpkg_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = list_files(_layer_files(spark, sf_dir), suffix="gpkg", spark=spark)
    return read_gpkg_tables(paths, "points").select("id", "category", "balance")


def _merged_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of customers with a number as code; those in debt have text there, and one more column."""

    def write(folder: str) -> None:
        rows = _customers(spark, sf_dir).withColumn("segment", F.col("layer")).withColumn("layer", F.lit("points"))
        number = rows.filter("x >= 0").select("layer", "fid", "x", "y", "id", F.col("id").alias("code"))
        text = rows.filter("x < 0").select("layer", "fid", "x", "y", "id", F.col("category").alias("code"), "segment")
        for name, own in (("a_", number), ("b_", text)):
            file = F.concat(F.lit(name), _part("id", PART_ROWS), F.lit(".gpkg"))
            write_vector_files(own.withColumn("file", file), folder, "geopackage")

    return _once(spark, sf_dir, "customer-merged", write)


def q_read_gpkg_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = list_files(_merged_files(spark, sf_dir), suffix="gpkg", spark=spark)
    return read_gpkg_tables(paths, "points", merge_schemas=True).select("id", "code", "segment")


def q_read_gpkg_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first layer of every file, all files in one read."""
    paths = list_files(_order_files(spark, sf_dir), suffix="gpkg", spark=spark)
    rows = read_gpkg_files(paths, drop_gpb_header=True)
    point = wkb_xy("wkb_geometry").alias("p")
    return rows.select("feature_id", "id", "category", point).select("feature_id", "id", "category", "p.x", "p.y")


def q_read_gpkg(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = list_files(_order_files(spark, sf_dir), suffix="gpkg", spark=spark)
    split = gpb.split_geometry(read_gpkg_tables(paths, "orders", 7000))
    header, point = F.col("gpb_header"), wkb_xy("wkb_geometry").alias("p")
    found = split.select("feature_id", "id", "category", header["srs_id"].alias("srs_id"), point)
    return found.select("feature_id", "id", "category", "srs_id", "p.x", "p.y")


def q_gpkg_list_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = list_files(_layered_customer_files(spark, sf_dir), suffix="gpkg", spark=spark)
    return gpkg_contents(paths).select(_file_name(), "table_name")


def q_gpkg_crs(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = list_files(_layered_customer_files(spark, sf_dir), suffix="gpkg", spark=spark)
    return gpkg_crs(paths).select(_file_name(), "layer_name", "srs_id", "definition")


def q_gpkg_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = list_files(_layered_customer_files(spark, sf_dir), suffix="gpkg", spark=spark)
    return gpkg_bounds(paths).select(_file_name(), "layer_name", "min_x", "min_y", "max_x", "max_y")


def q_computed_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt have empty geometries, whose corners are no numbers."""
    empty = F.col("c_acctbal") < 0
    x, y = (F.when(empty, float("nan")).otherwise(F.col(name).cast("double")) for name in ("c_acctbal", "c_custkey"))
    customer = _table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("layer_name"), gpb_boxed_points(x, y).alias("geom")
    )
    return computed_bounds(customer, ["layer_name"])


def q_split_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = gpb.split_geometry(_gpb_orders(spark, sf_dir), "geom", drop_gpb_header=True)
    point = wkb_xy("wkb_geometry").alias("p")
    found = split.select("o_orderkey", F.length("wkb_geometry").alias("wkb_len"), point)
    return found.select("o_orderkey", "wkb_len", "p.x", "p.y")


def q_unpack_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = gpb.split_geometry(_gpb_orders(spark, sf_dir), "geom").select("o_orderkey", "gpb_header.*")
    corners = [F.col("envelope").getItem(i).alias(name) for i, name in enumerate(("min_x", "max_x", "min_y", "max_y"))]
    return header.select("o_orderkey", "magic", "version", "flags", "srs_id", *corners)


def q_header_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = (F.col("c_custkey") % 5).cast("int")
    blob = gpb_points("c_acctbal", F.col("c_custkey").cast("double"), code).alias("geom")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", blob)
    wkb_len = F.length(gpb.wkb_bytes(F.col("geom")))
    return customer.select("c_custkey", gpb.header_length(F.col("geom")).alias("header_len"), wkb_len.alias("wkb_len"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: bounds of the decoded GeoPackage geometries of each customer segment."""
    return _run(q_computed_bounds, spark, "/root/testdata/sf0.001")


def _run(query: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return query(spark, sf_dir)


def _reader_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by name."""
    return {name: partial(_run, query) for name, query in globals().items() if name.startswith("q_")}


# --- SQL equivalents -------------------------------------------------------

_CUSTOMER_POLYGONS = (
    "select c_custkey id, 177 as bytes, c_acctbal min_x, c_acctbal + 4 max_x,"
    " c_custkey::double min_y, c_custkey::double + 4 max_y from customer"
)
_CUSTOMER_POINTS = "select c_custkey id, c_name category, c_acctbal x, c_custkey::double y from customer"
_ORDER_POINTS = "select o_orderkey id, o_orderpriority category, o_totalprice x, o_custkey::double y from orders"
_LAYER_RANK = (
    "select event_id, user_id from (select event_id, user_id,"
    " dense_rank() over (partition by event_id // 5000 order by event_type) r from events) where r = "
)
# layers whose ids are sparse are cut at every 250th row, others at every 250th id
_RANGES = (
    "with e as (select 'events_' || (event_id // 5000) || '.gpkg' as file_name, event_type as layer_name, event_id i"
    " from events), l as (select file_name, layer_name, count(*) n, min(i) lo, max(i) hi from e group by 1, 2),"
    " s as (select file_name, layer_name, i, hi from (select e.*, n, lo, hi, row_number() over"
    " (partition by file_name, layer_name order by i) - 1 k from e join l using (file_name, layer_name))"
    " where hi - lo + 1 > 4 * n and k % 250 = 0 union all select file_name, layer_name, unnest(range(lo, hi + 1, 250)),"
    " hi from l where hi - lo + 1 <= 4 * n), r as (select file_name, layer_name, i as start, coalesce(lead(i) over"
    " (partition by file_name, layer_name order by i), hi + 1) as stop from s) "
)
_TYPES = (
    "(0,0,'int'),(0,1,'boolean'),(0,2,'smallint'),(1,0,'array<int>'),(1,1,'array<boolean>'),(1,2,'array<smallint>'),"
    "(2,0,'double'),(2,3,'float'),(3,0,'array<double>'),(3,3,'array<float>'),(4,0,'string'),(4,4,'string'),"
    "(4,5,'string'),(5,0,'array<string>'),(6,0,'string'),(7,0,'array<string>'),(8,0,'binary'),(9,0,'string'),"
    "(10,0,'string'),(11,0,'string'),(12,0,'bigint'),(13,0,'array<bigint>')"
)
_DECLARED_TYPES = (
    "(0,'BOOLEAN','boolean'),(1,'TINYINT','tinyint'),(2,'SMALLINT','smallint'),(3,'MEDIUMINT','int'),(4,'INT','bigint'),"
    "(5,'INTEGER','bigint'),(6,'FLOAT','float'),(7,'DOUBLE','double'),(8,'REAL','double'),(9,'TEXT','string'),"
    "(10,'TEXT(20)','string'),(11,'BLOB','binary'),(12,'BLOB(9)','binary'),(13,'POINT','binary'),"
    "(14,'MULTIPOLYGON','binary'),(15,'DATE','date'),(16,'DATETIME','string'),(17,'NUMERIC','string')"
)
_PART_FILE = "'part_' || (c_custkey // 1000) || '.gpkg'"


def _reader_sql() -> dict[str, str]:
    """DuckDB SQL for each query."""
    return {
        "q_list_files": "select distinct 'BUILDING_' || (c_custkey // 3000) || '.shp' as file_name"
        " from customer where c_mktsegment = 'BUILDING'",
        "q_list_files_recursive": "select c_mktsegment as folder, count(distinct c_custkey // 3000) as files"
        " from customer group by 1",
        "q_archive_paths": "select page_id, '/vsigzip//' || ltrim(url, '/') as vsi_path from pages",
        "q_read_archive": _CUSTOMER_POINTS,
        "q_read_zip": _CUSTOMER_POINTS,
        "q_layer_catalog": "select 'events_' || f || '.gpkg' as file_name, cast(row_number() over"
        " (partition by f order by event_type) - 1 as int) as layer_index, event_type as layer_name, feature_count"
        " from (select event_id // 5000 f, event_type, count(*) feature_count from events group by 1, 2)",
        "q_layer_by_name": "select event_id, user_id from events where event_type = 'click'",
        "q_layer_by_index": _LAYER_RANK + "2",
        "q_first_layer": _LAYER_RANK + "1",
        "q_feature_counts": "select event_type as layer_name, count(*) as feature_count from events group by 1",
        "q_plan_chunks": _RANGES + "select * from r",
        "q_total_chunks": _RANGES + "select count(*) as total_chunks from r",
        "q_chunk_table": _RANGES
        + "select file_name, layer_name, row_number() over (order by file_name, layer_name, start) - 1 as id, start, stop from r",
        "q_read_files": _ORDER_POINTS,
        "q_read_rows": _ORDER_POINTS,
        "q_read_rows_sparse": _CUSTOMER_POINTS,
        "q_read_shapefile": _CUSTOMER_POINTS,
        "q_read_shapefile_rows": _CUSTOMER_POINTS,
        "q_read_shapefile_folder": _CUSTOMER_POINTS + " where c_mktsegment = 'MACHINERY'",
        "q_geojson": _CUSTOMER_POINTS,
        "q_geojson_lines": _CUSTOMER_POINTS,
        "q_geojson_sequence": _CUSTOMER_POINTS,
        "q_geojson_nested_type": _CUSTOMER_POINTS,
        "q_read_lines": "select c_custkey id, (9 + 16 * n)::int as bytes, c_acctbal min_x, c_acctbal + (n - 1) max_x,"
        " c_custkey::double - (n - 1) min_y, c_custkey::double max_y"
        " from (select *, 2 + c_custkey % 4 as n from customer)",
        "q_read_polygons": _CUSTOMER_POLYGONS,
        "q_gml_polygons": _CUSTOMER_POLYGONS,
        "q_read_geometry": "select c_custkey id, 3857 srid, c_acctbal x, c_custkey::double y from customer",
        "q_read_bbox": _CUSTOMER_POLYGONS + " where c_acctbal <= 4000 and c_acctbal + 4 >= -100"
        " and c_custkey <= 1200 and c_custkey + 4 >= 100",
        "q_read_gpkg_mixed": "select c_custkey id, c_name category, case when c_acctbal >= 0 then c_acctbal end balance"
        " from customer",
        "q_read_gpkg_merged": "select c_custkey id, case when c_acctbal >= 0 then c_custkey::varchar else c_name end code,"
        " case when c_acctbal < 0 then c_mktsegment end segment from customer",
        "q_read_gpkg_layer": "select o_orderkey feature_id, o_orderkey id, o_orderpriority category, o_totalprice x,"
        " o_custkey::double y from orders",
        "q_read_schema": "select t.pos, t.name, t.spark_type, count(*) as n from customer, (values (0, 'id', 'bigint'),"
        " (1, 'category', 'string'), (2, 'geometry', 'binary')) t(pos, name, spark_type) group by all",
        "q_gml": _CUSTOMER_POINTS,
        "q_wkb_points": "select o_orderkey id, o_totalprice x, o_custkey::double y from orders",
        "q_null_geometry": "select c_custkey id, c_acctbal < 0 as is_null from customer",
        "q_tolerant_read": "select s_suppkey id, s_name category, s_acctbal balance from supplier",
        "q_skipped_files": "select 'supplier_' || (s_suppkey // 50) || '.gpkg' as file_name, count(*) features"
        " from supplier group by 1 union all select 'broken.gpkg', null",
        "q_infer_schema": "select f.file_name, t.pos, t.name, t.spark_type from (select distinct c_mktsegment || '_' ||"
        " (c_custkey // 3000) || '.shp' as file_name from customer) f, (values (0, 'id', 'bigint'),"
        " (1, 'category', 'string')) t(pos, name, spark_type)",
        "q_type_map": "select t.spark_type, count(*) as fields from lineitem l left join (values " + _TYPES + ")"
        " t(a, b, spark_type) on l.l_partkey % 14 = t.a and l.l_suppkey % 6 = t.b group by 1",
        "q_gpkg_type_map": "select t.declared_type, t.spark_type, count(*) as fields from lineitem l join (values "
        + _DECLARED_TYPES
        + ") t(k, declared_type, spark_type) on l.l_partkey % 18 = t.k group by 1, 2",
        "q_conform_schema": "select s_suppkey::varchar id, s_name category, null::bigint missing_long from supplier",
        "q_add_missing": "select s_suppkey id, null::int m_int, null::boolean m_bool from supplier",
        "q_drop_additional": "select c_custkey id, c_mktsegment category from customer",
        "q_union_files": "select c_custkey id, c_name category, c_acctbal bal from customer"
        " union all select s_suppkey, s_name, cast(null as double) from supplier",
        "q_coerce_files": "select c_custkey id, c_name category, case when c_acctbal < 0 then c_acctbal end balance,"
        " null::boolean flag from customer",
        "q_user_schema": "select o_orderkey id, o_orderpriority category from orders",
        "q_read_gpkg": "select o_orderkey feature_id, o_orderkey id, o_orderpriority category, 27700 srs_id,"
        " o_totalprice x, o_custkey::double y from orders",
        "q_gpkg_list_layers": f"select distinct {_PART_FILE} as file_name, c_mktsegment table_name from customer",
        "q_gpkg_crs": f"select c.file_name, c.layer_name, c.k as srs_id, n.n_name as definition from"
        f" (select {_PART_FILE} as file_name, c_mktsegment layer_name, min(c_nationkey) k from customer group by 1, 2) c"
        " join nation n on n.n_nationkey = c.k",
        "q_gpkg_bounds": f"select {_PART_FILE} as file_name, c_mktsegment layer_name, min(c_acctbal) min_x,"
        " min(c_custkey)::double min_y, max(c_acctbal) max_x, max(c_custkey)::double max_y from customer group by 1, 2",
        "q_computed_bounds": "select c_mktsegment layer_name, min(c_acctbal) min_x, min(c_custkey)::double min_y,"
        " max(c_acctbal) max_x, max(c_custkey)::double max_y from customer where c_acctbal >= 0 group by 1",
        "q_split_geometry": "select o_orderkey, 21 wkb_len, o_totalprice x, o_custkey::double y from orders",
        "q_unpack_header": "select o_orderkey, 'GP' magic, 0 as version, '00000011' flags, 27700 srs_id,"
        " o_totalprice min_x, o_totalprice max_x, o_custkey::double min_y, o_custkey::double max_y from orders",
        "q_header_length": "select c_custkey, (case c_custkey % 5 when 0 then 8 when 1 then 40 when 4 then 72 else 56 end)"
        " header_len, 21 wkb_len from customer",
    }


def _corpus_modules() -> tuple[ModuleType, ModuleType] | None:
    """The corpus operators may have been taken out, or a library they need; the rest works without them."""
    try:
        import corpus_pipeline
        from featureframe.llm import queries as corpus_queries
    except ImportError:
        return None
    return corpus_pipeline, corpus_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _reader_queries()
    if modules := _corpus_modules():
        found |= modules[1].QUERIES | {"pipeline": modules[0].run}
    return found


def oracle_sql() -> dict[str, str]:
    found = _reader_sql()
    if modules := _corpus_modules():
        found |= modules[1].ORACLE
        if modules[0].ORACLE_SQL is not None:
            found["pipeline"] = modules[0].ORACLE_SQL
    return found
