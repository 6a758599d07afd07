from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from featureframe.functions.gpb import header_bytes, header_length, split_geometry, unpack_header, wkb_bytes
from featureframe.functions.wkb import little_endian, point_wkb, wkb_bounds, wkb_xy
from featureframe.gpkg import computed_bounds
from featureframe.testing.encode import gpb_point


def blobs(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, geom binary")


CASES = [(code, little) for code in range(5) for little in (True, False)]


def test_every_envelope_and_byte_order(spark):
    df = blobs(spark, *[gpb_point(1.5, -2.0, -7, code, little) for code, little in CASES])
    rows = split_geometry(df).orderBy("id").collect()
    lengths = [r[0] for r in df.select(header_length(F.col("geom"))).orderBy("id").collect()]
    for (code, little), row, length in zip(CASES, rows, lengths):
        doubles = [0, 4, 6, 6, 8][code]
        assert length == 8 + 8 * doubles
        header = row["gpb_header"]
        assert header["magic"] == "GP"
        assert header["version"] == 0
        assert header["flags"] == format(code << 1 | little, "08b")
        assert header["srs_id"] == -7
        assert header["envelope"] == ([1.5, 1.5, -2.0, -2.0, 0.0, 0.0, 0.0, 0.0][:doubles] or None)
        assert row["wkb_geometry"] == struct.pack("<BIdd", 1, 1, 1.5, -2.0)


def test_null_and_invalid_blobs(spark):
    invalid = bytes([*b"GP", 0, 7 << 1 | 1, 0, 0, 0, 0])
    rows = split_geometry(blobs(spark, None, invalid)).orderBy("id").collect()
    assert rows[0]["gpb_header"] is None
    assert rows[0]["wkb_geometry"] is None
    assert rows[1]["wkb_geometry"] is None


def test_column_order_and_dropped_header(spark):
    df = blobs(spark, gpb_point(0.0, 0.0)).select("geom", "id").withColumn("last", F.lit(1))
    assert split_geometry(df).columns == ["id", "last", "gpb_header", "wkb_geometry"]
    dropped = split_geometry(df, drop_gpb_header=True)
    assert dropped.columns == ["id", "last", "wkb_geometry"]
    assert split_geometry(df).schema["gpb_header"].dataType.simpleString() == (
        "struct<magic:string,version:int,flags:string,srs_id:int,envelope:array<double>>"
    )


@pytest.mark.parametrize(("length", "code"), [(40, 1), (56, 2), (56, 3), (72, 4)])
def test_given_header_length(spark, length, code):
    row = split_geometry(blobs(spark, gpb_point(3.0, 4.0, code=code)), fixed_header_length=length).first()
    assert row["gpb_header"]["envelope"][:4] == [3.0, 3.0, 4.0, 4.0]
    assert len(row["wkb_geometry"]) == 21


def test_header_fields_stay_native(spark):
    df = blobs(spark, gpb_point(0.0, 0.0))
    header = unpack_header(header_bytes(F.col("geom")))
    plan = df.select(header["srs_id"], wkb_bytes(F.col("geom")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_point_round_trip(spark):
    df = spark.createDataFrame([(1.5, -2.25), (None, 1.0), (1e308, 5e-324)], "x double, y double")
    rows = df.select(wkb_xy(point_wkb("x", "y")).alias("p")).collect()
    assert [r["p"] and tuple(r["p"]) for r in rows] == [(1.5, -2.25), None, (1e308, 5e-324)]


LINE = struct.pack("<BII4d", 1, 2, 2, 0, 5, -3, 1)
BIG_LINE = struct.pack(">BII4d", 0, 2, 2, 0, 5, -3, 1)
ISO_Z = struct.pack("<BI3d", 1, 1001, 1, 2, 3)
FLAG_Z = struct.pack("<BI3d", 1, 0x80000001, 1, 2, 3)
MULTI_Z = struct.pack("<BII", 1, 1004, 2) + ISO_Z + struct.pack(">BI3d", 0, 1001, 4, 5, 6)
POLYGON = struct.pack("<BIII8d", 1, 3, 1, 4, 0, 0, 9, 0, 9, 7, 0, 0)
EMPTY = struct.pack("<BII", 1, 2, 0)
NAN_POINT = struct.pack("<BIdd", 1, 1, float("nan"), float("nan"))


def test_little_endian():
    assert little_endian(LINE) == LINE
    assert little_endian(BIG_LINE) == LINE
    assert little_endian(ISO_Z) == FLAG_Z
    assert little_endian(MULTI_Z) == struct.pack("<BII", 1, 0x80000004, 2) + FLAG_Z + struct.pack(
        "<BI3d", 1, 0x80000001, 4, 5, 6
    )
    mixed = struct.pack("<BII", 1, 5, 1) + BIG_LINE
    assert little_endian(mixed) == struct.pack("<BII", 1, 5, 1) + LINE
    measured = struct.pack(">BI3d", 0, 2001, 1, 2, 3)
    assert little_endian(measured) == struct.pack("<BI3d", 1, 2001, 1, 2, 3)


def test_bounds_of_any_geometry(spark):
    df = spark.createDataFrame(
        [(i, g) for i, g in enumerate([LINE, BIG_LINE, MULTI_Z, POLYGON, EMPTY, None, NAN_POINT])], "id int, g binary"
    )
    rows = [r[0] for r in df.coalesce(1).orderBy("id").select(wkb_bounds("g")).collect()]
    assert rows == [[-3, 0, 1, 5], [-3, 0, 1, 5], [1, 4, 2, 5], [0, 9, 0, 7], None, None, None]
    points = spark.createDataFrame([(NAN_POINT,), (struct.pack("<BIdd", 1, 1, 2, 3),)], "g binary").coalesce(1)
    assert [r[0] for r in points.select(wkb_bounds("g")).collect()] == [None, [2, 2, 3, 3]]


def test_computed_bounds_with_and_without_envelopes(spark):
    values = [gpb_point(float(i), -float(i), code=i % 2) for i in range(10)]
    bounds = computed_bounds(blobs(spark, *values, None).withColumn("k", F.lit("a")), ["k"])
    assert tuple(bounds.first()) == ("a", 0.0, -9.0, 9.0, 0.0)


def test_one_hot_group_is_combined_before_the_shuffle(spark):
    hot = spark.range(20_000).select(F.lit("a").alias("k"), F.lit(gpb_point(1.0, 2.0)).alias("geom"))
    plan = computed_bounds(hot, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
