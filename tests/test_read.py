"""End to end: every kind of source under both strategies."""

from __future__ import annotations

import errno
import os
import pathlib
import resource
import sqlite3
import struct
from contextlib import closing

import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featureframe import describe_layers, read_vector_files
from featureframe.gpkg import read_gpkg_files, read_gpkg_tables
from featureframe.plans.catalog import feature_counts, select_layer, skipped_files
from featureframe.sources import geopackage as source
from featureframe.sources import shapefile
from featureframe.sources.layers import NotVectorData
from featureframe.sources.tasks import not_vector_data
from featureframe.testing.encode import write_geopackage
from tests.conftest import (
    FIRST,
    OTHER_FIRST,
    OTHER_SECOND,
    SCHEMA,
    SECOND,
    THIRD,
    collected,
    expected,
    row,
    write_layers,
    write_parts,
)

STRATEGIES = pytest.mark.parametrize("strategy", ["files", "rows"])


@STRATEGIES
@pytest.mark.parametrize(
    ("source", "suffix", "prefix", "layer", "rows"),
    [
        ("shapefiles", ".shp", None, None, FIRST + SECOND),
        ("shapefiles", ".gz", "/vsitar/", None, FIRST + SECOND),
        ("folders", ".gdb", None, None, FIRST + OTHER_FIRST),
        ("folders", ".gdb", None, "second", SECOND + OTHER_SECOND),
        ("folders", ".gdb", None, 1, SECOND + OTHER_SECOND),
        ("folders", ".gdb", None, "third", THIRD),
    ],
)
@pytest.mark.parametrize("size", [1, 3_000_000])
def test_read(spark, request, strategy, source, suffix, prefix, layer, rows, size):
    df = read_vector_files(
        request.getfixturevalue(source),
        suffix=suffix,
        vsi_prefix=prefix,
        layer_identifier=layer,
        concurrency_strategy=strategy,
        ideal_chunk_size=size,
        spark=spark,
    )
    assert df.schema == SCHEMA
    assert collected(df) == expected(rows)


@STRATEGIES
def test_geopackage_layers(spark, geopackage, strategy):
    folder = os.path.dirname(geopackage)
    for layer, rows in ((None, FIRST), (0, FIRST), (1, SECOND), ("second", SECOND)):
        df = read_vector_files(folder, suffix="gpkg", layer_identifier=layer, concurrency_strategy=strategy, spark=spark)
        assert collected(df) == expected(rows)


def test_default_session_and_argument_order(spark, shapefiles):
    from featureframe import OGR_TO_SPARK

    assert collected(read_vector_files(shapefiles, OGR_TO_SPARK, "second", "shp")) == expected(SECOND)


def test_unknown_strategy(spark, shapefiles):
    with pytest.raises(ValueError):
        read_vector_files(shapefiles, suffix="shp", concurrency_strategy="columns", spark=spark)


@STRATEGIES
def test_files_without_the_layer_give_no_rows(spark, tmp_path, strategy):
    write_layers(str(tmp_path / "a.gpkg"), {"first": FIRST, "second": SECOND})
    write_layers(str(tmp_path / "b.gpkg"), {"first": OTHER_FIRST})
    df = read_vector_files(str(tmp_path), suffix="gpkg", layer_identifier=1, concurrency_strategy=strategy, spark=spark)
    assert collected(df) == expected(SECOND)
    with pytest.raises(ValueError):
        read_vector_files(str(tmp_path), suffix="gpkg", layer_identifier="fourth", spark=spark)
    with pytest.raises(ValueError):
        read_vector_files(str(tmp_path), suffix="gpkg", layer_identifier=-1, spark=spark)


@STRATEGIES
def test_broken_files_are_passed_over(spark, tmp_path, strategy):
    (tmp_path / "a.gpkg").write_bytes(b"junk" * 1000)
    (tmp_path / "b.shp").write_bytes(b"junk" * 1000)
    (tmp_path / "c.txt").write_text("no vector file")
    write_layers(str(tmp_path / "d.gpkg"), {"first": FIRST})
    arguments = {"path": str(tmp_path), "concurrency_strategy": strategy, "spark": spark}
    assert collected(read_vector_files(**arguments)) == expected(FIRST)
    with pytest.raises((PythonException, ValueError)):
        read_vector_files(**arguments, mode="FAILFAST").collect()
    catalog = describe_layers(str(tmp_path), spark=spark)
    assert sorted(os.path.basename(r["path"]) for r in skipped_files(catalog).collect()) == ["a.gpkg", "b.shp", "c.txt"]


@STRATEGIES
def test_all_files_broken(spark, tmp_path, strategy):
    (tmp_path / "a.gpkg").write_bytes(b"junk" * 1000)
    arguments = {"path": str(tmp_path), "suffix": "gpkg", "concurrency_strategy": strategy, "spark": spark}
    with pytest.raises(ValueError):
        read_vector_files(**arguments)
    assert read_vector_files(**arguments, schema=SCHEMA).collect() == []


@STRATEGIES
def test_empty_layer(spark, tmp_path, strategy):
    write_parts(tmp_path / "empty", [])
    df = read_vector_files(str(tmp_path), suffix="shp", concurrency_strategy=strategy, spark=spark)
    assert df.schema == SCHEMA
    assert df.collect() == []


@STRATEGIES
def test_sparse_ids_lose_no_row(spark, tmp_path, strategy):
    # two thirds of the rows sit in one dense run, the rest far apart
    rows = [row(i, "dense", 0.0, 0.0) for i in range(200)]
    rows += [row(10**9 + i * 10**7, "far", 1.0, 1.0) for i in range(100)]
    write_layers(str(tmp_path / "a.gpkg"), {"first": rows})
    df = read_vector_files(str(tmp_path), suffix="gpkg", concurrency_strategy=strategy, ideal_chunk_size=30, spark=spark)
    assert collected(df) == expected(rows)
    if strategy == "rows":
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 30


def test_rows_strategy_reads_one_chunk_per_partition(spark, tmp_path):
    rows = [row(i, "x", 0.0, 0.0) for i in range(1, 101)]
    write_layers(str(tmp_path / "a.gpkg"), {"first": rows})
    df = read_vector_files(str(tmp_path), suffix="gpkg", concurrency_strategy="rows", ideal_chunk_size=10, spark=spark)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sizes == [10] * 10


def test_large_files_are_split_under_the_files_strategy(spark, tmp_path):
    rows = [row(i, "x", 0.0, 0.0) for i in range(100)]
    write_layers(str(tmp_path / "a.gpkg"), {"first": rows})
    write_layers(str(tmp_path / "b.gpkg"), {"first": [row(i, "y" * 1000, 0.0, 0.0) for i in range(100, 400)]})
    whole = os.path.getsize(tmp_path / "a.gpkg")
    df = read_vector_files(str(tmp_path), suffix="gpkg", ideal_chunk_size=50, spark=spark, split_bytes=whole)
    assert df.select("id").distinct().count() == df.count() == 400
    assert len(df.groupBy(F.spark_partition_id()).count().collect()) == 1 + 6


def test_recursive(spark, tmp_path):
    write_layers(str(tmp_path / "a.gpkg"), {"first": FIRST})
    write_layers(str(tmp_path / "sub" / "b.gpkg"), {"first": SECOND})
    assert collected(read_vector_files(str(tmp_path), suffix="gpkg", spark=spark)) == expected(FIRST)
    assert collected(read_vector_files(str(tmp_path), suffix="gpkg", recursive=True, spark=spark)) == expected(FIRST + SECOND)


def test_recursive_folders(spark, tmp_path):
    write_parts(tmp_path / "sub" / "a.gdb" / "first", FIRST)
    write_parts(tmp_path / "b.gdb" / "first", SECOND)
    assert collected(read_vector_files(str(tmp_path), suffix="gdb", spark=spark)) == expected(SECOND)
    assert collected(read_vector_files(str(tmp_path), suffix="gdb", recursive=True, spark=spark)) == expected(FIRST + SECOND)


@STRATEGIES
def test_differing_files_need_coercion(spark, tmp_path, strategy):
    write_layers(str(tmp_path / "a.gpkg"), {"first": FIRST})
    more = [row(2, None, None, None, size=1.5), row(3, "D", 0.0, 1.0, size=None)]
    write_layers(str(tmp_path / "b.gpkg"), {"first": more}, [("size", "double"), ("id", "string")])
    arguments = {"path": str(tmp_path), "suffix": "gpkg", "concurrency_strategy": strategy, "spark": spark}
    with pytest.raises(PythonException, match="does not fit the schema"):
        read_vector_files(**arguments).collect()
    schema = StructType.fromDDL("id bigint, size double, category string, flag boolean, geometry binary")
    df = read_vector_files(**arguments, schema=schema, coerce_to_schema=True)
    assert sorted(tuple(r)[:4] for r in df.collect()) == [
        (0, None, "A", None),
        (1, None, "B", None),
        (2, 1.5, None, None),
        (3, None, None, None),
    ]


def test_schema_is_a_projection(spark, geopackage):
    df = read_vector_files(os.path.dirname(geopackage), suffix="gpkg", schema=StructType.fromDDL("category string"), spark=spark)
    assert sorted(r[0] for r in df.collect()) == ["A", "B"]


def test_geometry_name(spark, geopackage):
    df = read_vector_files(os.path.dirname(geopackage), suffix="gpkg", geom_field_name="shape", spark=spark)
    assert df.columns == ["id", "category", "shape"]
    assert df.filter("shape is null").count() == 0


def test_catalog(spark, folders):
    catalog = describe_layers(folders, suffix="gdb", spark=spark)
    counts = feature_counts(catalog).collect()
    assert sorted((os.path.basename(r["path"]), r["layer_name"], r["feature_count"]) for r in counts) == [
        ("first.gdb", "first", 2),
        ("first.gdb", "second", 2),
        ("first.gdb", "third", 2),
        ("second.gdb", "first", 2),
        ("second.gdb", "second", 2),
    ]
    assert [r["layer_name"] for r in select_layer(catalog, 2).collect()] == ["third"]
    assert {r["layer_name"] for r in select_layer(catalog, None).collect()} == {"first"}
    with pytest.raises(ValueError):
        select_layer(catalog, -1)


def test_mixed_sources_in_one_folder(spark, tmp_path):
    write_layers(str(tmp_path / "a.gpkg"), {"first": FIRST})
    write_parts(tmp_path / "b", SECOND)
    features = '{"type":"Feature","properties":{"id":4,"category":"E"},"geometry":{"type":"Point","coordinates":[1,1]}}'
    (tmp_path / "c.geojson").write_text('{"type":"FeatureCollection","features":[' + features + "]}")
    df = read_vector_files(str(tmp_path), schema=SCHEMA, coerce_to_schema=True, spark=spark)
    # the .dbf beside the .shp is part of it, not a source of its own
    assert collected(df) == expected(FIRST + SECOND + OTHER_FIRST[:1])


@pytest.mark.parametrize(
    ("error", "passed_over"),
    [
        (NotVectorData("not a shapefile"), True),
        (FileNotFoundError("gone"), False),
        (ValueError("other"), False),
        (OSError(errno.EIO, "disk"), False),
        (MemoryError(), False),
        (RuntimeError("other"), False),
    ],
)
def test_only_format_errors_are_passed_over(error, passed_over):
    assert not_vector_data(error) is passed_over


def test_locked_geopackage_is_an_error(geopackage, monkeypatch):
    monkeypatch.setattr(source, "_LOCK_SECONDS", 0.1)
    with closing(sqlite3.connect(geopackage)) as db:
        db.execute("begin exclusive")
        with pytest.raises(sqlite3.OperationalError) as raised:
            source.layer_names(geopackage)
        assert not not_vector_data(raised.value)


def test_changes_that_wait_in_a_log_are_read_or_an_error(tmp_path):
    path = str(tmp_path / "a.gpkg")
    write_layers(path, {"first": FIRST})
    with closing(sqlite3.connect(path)) as db:
        db.execute("pragma journal_mode=wal")
        db.execute("insert into first (id, category) values (77, 'late')")
        db.commit()
        with closing(source.connect(path)) as other:
            assert other.execute("select count(*) from first where id = 77").fetchone() == (1,)


def test_only_a_file_that_is_gone_is_passed_over(tmp_path):
    for module, ending in ((source, "gpkg"), (shapefile, "shp")):
        with pytest.raises(NotVectorData):
            module.layer_names(str(tmp_path / f"gone.{ending}"))
        with pytest.raises(FileNotFoundError) as raised:
            module.layer_names(f"/erroneous/file/path.{ending}")
        assert not not_vector_data(raised.value)
        with pytest.raises((OSError, pa.ArrowException)) as raised:
            module.layer_names(f"hdfs://nowhere.invalid:1/a.{ending}")
        assert not not_vector_data(raised.value)


def test_no_descriptors_left_is_an_error(geopackage):
    limits = resource.getrlimit(resource.RLIMIT_NOFILE)
    held = []
    try:
        resource.setrlimit(resource.RLIMIT_NOFILE, (64, limits[1]))
        with pytest.raises((sqlite3.OperationalError, OSError)) as raised:
            while True:
                held.append(source.connect(geopackage))
        assert not not_vector_data(raised.value)
    finally:
        for one in held:
            one.close()
        resource.setrlimit(resource.RLIMIT_NOFILE, limits)


def test_failing_reads_of_a_member_are_errors(shapefiles, monkeypatch):
    def failing(path):
        if path.endswith(".dbf"):
            raise OSError(errno.EIO, "disk")
        return open(path, "rb")

    monkeypatch.setattr(shapefile, "open_binary", failing)
    path = next(str(one) for one in sorted(pathlib.Path(shapefiles).rglob("*.shp")))
    with pytest.raises(OSError) as raised:
        shapefile.attributes(path, shapefile.layer_names(path)[0])
    assert not not_vector_data(raised.value)


@STRATEGIES
def test_a_layer_no_file_has_is_an_error(spark, geopackage, strategy):
    with pytest.raises(ValueError, match="nowhere"):
        read_vector_files(
            os.path.dirname(geopackage), suffix="gpkg", layer_identifier="nowhere", schema=SCHEMA,
            concurrency_strategy=strategy, spark=spark,
        )


@STRATEGIES
def test_other_types_need_coercion(spark, tmp_path, strategy):
    for name, kind, value in (("a", "INTEGER", 1), ("b", "TEXT", "x17")):
        with closing(sqlite3.connect(tmp_path / f"{name}.sqlite")) as db:
            db.execute(f"create table t (code {kind}, other TEXT)")
            db.execute("insert into t values (?, 'o')", (value,))
            db.commit()
    arguments = {"path": str(tmp_path), "suffix": "sqlite", "concurrency_strategy": strategy, "spark": spark}
    with pytest.raises(PythonException, match="coerce_to_schema"):
        read_vector_files(**arguments).collect()
    coerced = read_vector_files(**arguments, coerce_to_schema=True).collect()
    assert sorted((row.code, row.other) for row in coerced if row.code) == [(1, "o")] and len(coerced) == 2


def test_columns_a_table_lacks_are_null(spark, tmp_path):
    for name, columns in (("a", "name, owner"), ("b", "name")):
        with closing(sqlite3.connect(tmp_path / f"{name}.sqlite")) as db:
            db.execute(f"create table t ({columns.replace(',', ' TEXT,')} TEXT)")
            db.execute(f"insert into t (name) values ('{name}')")
            db.commit()
    paths = spark.createDataFrame([(str(tmp_path / f"{name}.sqlite"),) for name in "ab"], "path string")
    rows = read_gpkg_tables(paths, "t").collect()
    assert sorted((row.name, row.owner) for row in rows) == [("a", None), ("b", None)]


def _sqlite_files(folder, **tables):
    """Files of a table ``t``: its columns with their types, and rows."""
    for name, (columns, rows) in tables.items():
        with closing(sqlite3.connect(folder / f"{name}.sqlite")) as db:
            db.execute(f"create table t ({columns})")
            db.executemany(f"insert into t values ({','.join('?' * len(rows[0]))})", rows)
            db.commit()


def _sqlite_paths(spark, folder):
    return spark.createDataFrame([(str(path),) for path in sorted(folder.iterdir())], "path string")


def test_tables_with_other_types_or_more_columns(spark, tmp_path):
    _sqlite_files(tmp_path, a=("code INTEGER", [(7,)]), b=("code TEXT", [("x17",), ("8",)]))
    with pytest.raises(Exception, match="code that are no int64; set merge_schemas"):
        read_gpkg_tables(_sqlite_paths(spark, tmp_path), "t").collect()
    _sqlite_files(tmp_path, c=("CODE INTEGER, owner TEXT", [(9, "o")]))
    with pytest.raises(ValueError, match=r"c.sqlite has more columns: \['owner'\]"):
        read_gpkg_tables(_sqlite_paths(spark, tmp_path), "t")
    merged = read_gpkg_tables(_sqlite_paths(spark, tmp_path), "t", merge_schemas=True)
    assert merged.schema.simpleString() == "struct<code:string,owner:string>"
    assert sorted(map(tuple, merged.collect())) == [("7", None), ("8", None), ("9", "o"), ("x17", None)]


def test_fitting_values_of_other_types_are_read(spark, tmp_path):
    _sqlite_files(tmp_path, a=("code BIGINT, n INTEGER", [("7", 1)]), b=("code TEXT, n SMALLINT", [("8", 2), (None, None)]))
    rows = read_gpkg_tables(_sqlite_paths(spark, tmp_path), "t").collect()
    assert sorted(map(tuple, rows), key=str) == [("7", 1), ("8", 2), (None, None)]


def test_merged_types_lose_nothing(spark, tmp_path):
    columns = "i {}, r {}, b {}, d {}"
    _sqlite_files(
        tmp_path,
        a=(columns.format("MEDIUMINT", "FLOAT", "BLOB", "DATE"), [(1, 0.5, b"\0", "2020-01-31")]),
        b=(columns.format("INTEGER", "INTEGER", "TEXT", "DATETIME"), [(2**40, 3, "é", "2020-01-31T00:00:00Z")]),
    )
    merged = read_gpkg_tables(_sqlite_paths(spark, tmp_path), "t", merge_schemas=True)
    assert merged.schema.simpleString() == "struct<i:bigint,r:double,b:binary,d:string>"
    expected = [(1, 0.5, b"\0", "2020-01-31"), (2**40, 3.0, "é".encode(), "2020-01-31T00:00:00Z")]
    assert sorted((row.i, row.r, bytes(row.b), row.d) for row in merged.collect()) == expected
    _sqlite_files(tmp_path, c=("r INTEGER", [(2**53 + 1,)]))
    with pytest.raises(Exception, match="r that are no double"):
        read_gpkg_tables(_sqlite_paths(spark, tmp_path), "t", merge_schemas=True).collect()
    _sqlite_files(tmp_path, d=("b INTEGER", [(1,)]))
    with pytest.raises(ValueError, match="column b has values of .* which no type holds"):
        read_gpkg_tables(_sqlite_paths(spark, tmp_path), "t", merge_schemas=True)


def test_first_layers_of_many_files_in_one_read(spark, tmp_path):
    for name, layer in (("a", "one"), ("b", "two")):
        rows = [{"fid": 1, "id": 1, "category": name, "x": 1.0, "y": 2.0, "layer": layer}]
        write_geopackage(str(tmp_path / f"{name}.gpkg"), rows, [("id", "bigint"), ("category", "string")])
    found = read_gpkg_files(_sqlite_paths(spark, tmp_path), drop_gpb_header=True)
    assert sorted((row.category, bytes(row.wkb_geometry)) for row in found.collect()) == [
        (name, struct.pack("<BIdd", 1, 1, 1, 2)) for name in "ab"
    ]
    assert read_gpkg_files(_sqlite_paths(spark, tmp_path), layer_name="two").count() == 1


def test_geometry_as_sparks_own_type(spark, geopackage):
    folder = str(pathlib.Path(geopackage).parent)
    plain = read_vector_files(folder, suffix="gpkg", spark=spark)
    assert plain.schema["geometry"].dataType.simpleString() == "binary"
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    try:
        own = read_vector_files(folder, suffix="gpkg", spark=spark, geometry_type="geometry", srid=4326)
        assert own.schema["geometry"].dataType.simpleString() == "geometry(4326)"
        back = own.select("id", "category", F.st_asbinary("geometry"), F.st_srid("geometry")).collect()
        assert sorted(row[:3] for row in back) == sorted(map(tuple, plain.collect()))
        assert {row[3] for row in back} == {4326}
        without = read_vector_files(folder, suffix="gpkg", spark=spark, geometry_type="geometry", schema=plain.select("id").schema)
        assert without.columns == ["id"]
    finally:
        spark.conf.set("spark.sql.geospatial.enabled", "false")
    with pytest.raises(ValueError, match="neither"):
        read_vector_files(folder, suffix="gpkg", spark=spark, geometry_type="geography")
