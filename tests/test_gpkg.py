from __future__ import annotations

import os
import sqlite3
import struct
from contextlib import closing

import pytest
from pyspark.sql import functions as F

from featureframe import read_vector_files
from featureframe.gpkg import (
    get_bounds,
    get_crs,
    gpkg_bounds,
    gpkg_contents,
    gpkg_crs,
    list_layers,
    read_gpkg,
    read_gpkg_table,
)
from featureframe.sources.geopackage import _date_time
from featureframe.testing.encode import gpb_point
from tests.conftest import FIRST, SECOND, point, row, write_layers


def test_layers_crs_and_bounds(spark, geopackage):
    assert list_layers(geopackage) == ["first", "second"]
    assert get_crs(geopackage, "first", spark) == "British_National_Grid"
    assert get_bounds(geopackage, "second", spark) == (0.0, 1.0, 1.0, 1.0)
    for ask in (get_crs, get_bounds):
        with pytest.raises(ValueError, match="first"):
            ask(geopackage, "fourth", spark)


def test_many_files_at_once(spark, tmp_path):
    paths = [write_layers(str(tmp_path / f"{i}.gpkg"), {"first": FIRST, "second": SECOND}) for i in range(3)]
    broken = tmp_path / "broken.gpkg"
    broken.write_bytes(b"junk" * 1000)
    df = spark.createDataFrame([(p,) for p in [*paths, str(broken)]], "path string")
    assert gpkg_contents(df).count() == 6
    assert {r["definition"] for r in gpkg_crs(df).collect()} == {"British_National_Grid"}
    assert gpkg_crs(df).count() == gpkg_bounds(df).count() == 6


def test_read_first_and_named_layer(spark, geopackage):
    df = read_gpkg(geopackage)
    assert df.columns == ["feature_id", "id", "category", "gpb_header", "wkb_geometry"]
    rows = df.orderBy("id").collect()
    assert [(r["feature_id"], r["id"], r["category"], r["wkb_geometry"]) for r in rows] == [
        (0, 0, "A", point(0, 0)),
        (1, 1, "B", point(1, 0)),
    ]
    assert rows[1]["gpb_header"].asDict() == {
        "magic": "GP",
        "version": 0,
        "flags": "00000011",
        "srs_id": 27700,
        "envelope": [1.0, 1.0, 0.0, 0.0],
    }
    second = read_gpkg(geopackage, layer_name="second", drop_gpb_header=True, header_length=40)
    assert second.columns == ["feature_id", "id", "category", "wkb_geometry"]
    assert sorted(r["id"] for r in second.collect()) == [2, 3]
    with pytest.raises(ValueError, match="has a table fourth"):
        read_gpkg(geopackage, layer_name="fourth")


def test_null_geometry(spark, tmp_path):
    path = write_layers(str(tmp_path / "a.gpkg"), {"first": [row(1, "A", None, None), row(2, "B", 1.0, 2.0)]})
    rows = read_gpkg(path).orderBy("id").collect()
    assert (rows[0]["gpb_header"], rows[0]["wkb_geometry"]) == (None, None)
    assert rows[1]["wkb_geometry"] == point(1, 2)


@pytest.fixture
def typed(tmp_path) -> str:
    path = str(tmp_path / "typed.gpkg")
    with closing(sqlite3.connect(path)) as db:
        db.execute(
            'create table "odd ""name""" (a BOOLEAN, b TINYINT, c SMALLINT, d MEDIUMINT, e INT, f FLOAT, g REAL,'
            " h TEXT(20), i BLOB, j DATE, k DATETIME, l NUMERIC, shape POLYGON)"
        )
        values = (1, 2, 3, 4, 2**40, 0.5, 1.5, "x", b"\x00\x01", "2020-01-31", "2020-01-31T12:34:56.000Z", 7)
        db.execute(f'insert into "odd ""name""" values ({",".join("?" * 13)})', (*values, gpb_point(1.0, 2.0)))
        db.execute(f'insert into "odd ""name""" values ({",".join("?" * 13)})', (None,) * 13)
        db.execute(f'insert into "odd ""name""" values ({",".join("?" * 13)})', ("no", "x", *["text"] * 11))
        db.commit()
    return path


def test_declared_types_and_odd_values(spark, typed):
    df = read_gpkg_table(typed, 'odd "name"')
    assert [f.dataType.simpleString() for f in df.schema] == (
        "boolean tinyint smallint int bigint float double string binary date string string binary".split()
    )
    rows = df.collect()
    first = next(r for r in rows if r["b"] == 2)
    assert (first["a"], first["e"], first["f"], str(first["j"]), first["l"]) == (True, 2**40, 0.5, "2020-01-31", "7")
    assert sum(all(v is None for v in r) for r in rows) == 1
    odd = next(r for r in rows if r["h"] == "text")
    assert (odd["a"], odd["b"], odd["e"], odd["g"], odd["j"]) == (False, None, None, None, None)


def test_plain_sqlite_as_vector_file(spark, typed):
    df = read_vector_files(os.path.dirname(typed), suffix="gpkg")
    found = next(r for r in df.collect() if r["h"] == "x")
    assert (found["j"], found["k"]) == ("2020/01/31", "2020/01/31 12:34:56+00")


@pytest.mark.parametrize(
    ("text", "shown"),
    [
        ("2020-01-31T12:34:56Z", "2020/01/31 12:34:56+00"),
        ("2020-01-31T12:34:56.250Z", "2020/01/31 12:34:56.250+00"),
        ("2020-01-31 12:34:56", "2020/01/31 12:34:56"),
        ("2020-01-31T12:34:56+01:00", "2020/01/31 12:34:56+01"),
        ("2020-01-31T12:34:56-05:30", "2020/01/31 12:34:56-0530"),
        ("yesterday", "yesterday"),
    ],
)
def test_date_times(text, shown):
    assert _date_time(text) == shown


def test_views_and_tables_without_rowid(spark, tmp_path):
    path = str(tmp_path / "a.sqlite")
    with closing(sqlite3.connect(path)) as db:
        db.execute("create table t (k INTEGER primary key, v TEXT) without rowid")
        db.executemany("insert into t values (?, ?)", [(i, str(i)) for i in range(100)])
        db.execute("create view w as select k, v from t where k < 10")
        db.commit()
    assert read_gpkg_table(path, "t").count() == 100
    assert read_gpkg_table(path, "w").count() == 10


def test_table_is_read_in_ranges(spark, tmp_path):
    rows = [row(i * 1000, "x", 0.0, 0.0) for i in range(500)]
    path = write_layers(str(tmp_path / "a.gpkg"), {"first": rows})
    df = read_gpkg_table(path, "first", spark, 50)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sizes == [50] * 10
    assert df.select("id").distinct().count() == 500


def test_big_endian_and_z_geometries_are_normalised(spark, tmp_path):
    path = write_layers(str(tmp_path / "a.gpkg"), {"first": [row(1, "A", 0.0, 0.0), row(2, "B", 0.0, 0.0)]})
    header = gpb_point(0.0, 0.0)[:40]
    with closing(sqlite3.connect(path)) as db:
        db.execute("update first set geom = ? where id = 1", (header + struct.pack(">BIdd", 0, 1, 3, 4),))
        db.execute("update first set geom = ? where id = 2", (header + struct.pack("<BI3d", 1, 1001, 1, 2, 3),))
        db.commit()
    rows = read_vector_files(str(tmp_path), suffix="gpkg", spark=spark).orderBy("id").collect()
    assert [bytes(r["geometry"]) for r in rows] == [
        struct.pack("<BIdd", 1, 1, 3, 4),
        struct.pack("<BI3d", 1, 0x80000001, 1, 2, 3),
    ]


def test_large_geometries_come_in_small_batches(tmp_path, monkeypatch):
    from featureframe.sources import geopackage as source

    path = write_layers(str(tmp_path / "a.gpkg"), {"first": [row(i, "x", 0.0, 0.0) for i in range(1000)]})
    with closing(sqlite3.connect(path)) as db:
        db.execute("update first set geom = zeroblob(20000) where id >= 100")
        db.commit()
    monkeypatch.setattr(source, "BATCH_BYTES", 200_000)
    counts = [count for count, _ in source.fetch(path, "first", ["id", "geom"], None, None)]
    assert sum(counts) == 1000
    assert set(counts[5:-1]) == {10}
