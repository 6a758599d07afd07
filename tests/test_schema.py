from __future__ import annotations

import datetime
import decimal

import pyarrow as pa
import pytest
from pyspark.sql.types import BinaryType, StringType, StructType

from featureframe.operators.fit import fit
from featureframe.operators.schema import (
    add_missing_columns,
    additional_columns,
    conform,
    drop_additional_columns,
    layer_schema,
    missing_fields,
    union_conformed,
)
from featureframe.types import OGR_TO_SPARK, sqlite_ogr_type, sqlite_spark_type
from tests.conftest import SCHEMA


def attribute(name, ogr_type, subtype=0):
    return {"name": name, "ogr_type": ogr_type, "ogr_subtype": subtype}


def test_layer_schema_puts_geometry_last():
    assert layer_schema([attribute("id", 12), attribute("category", 4)]) == SCHEMA


def test_layer_schema_geometry_name_type_and_map():
    types = dict(OGR_TO_SPARK) | {(12, 0): StringType()}
    schema = layer_schema([attribute("id", 12)], types, "shape", (4, 0))
    assert schema.simpleString() == "struct<id:string,shape:string>"


def test_unmapped_type_is_an_error():
    with pytest.raises(KeyError):
        layer_schema([attribute("id", 12, 9)])


def test_every_mapped_type():
    assert len(OGR_TO_SPARK) == 22
    assert OGR_TO_SPARK[8, 0] == BinaryType()


@pytest.mark.parametrize(
    ("declared", "spark_type", "pair"),
    [
        ("TEXT(20)", "string", (4, 0)),
        ("integer", "bigint", (12, 0)),
        ("NUMERIC", "string", (2, 0)),
        ("BOOLEAN", "boolean", (0, 1)),
        ("DATE", "date", (9, 0)),
        ("DATETIME", "string", (11, 0)),
        ("MULTIPOLYGON", "binary", (4, 0)),
    ],
)
def test_declared_types(declared, spark_type, pair):
    assert sqlite_spark_type(declared) == spark_type
    assert sqlite_ogr_type(declared) == pair


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def test_missing_and_additional(spark):
    df = frame(spark, "id bigint, extra string", (1, "x"))
    assert [field.name for field in missing_fields(df, SCHEMA)] == ["category", "geometry"]
    assert additional_columns(df, SCHEMA) == ["extra"]
    assert drop_additional_columns(df, SCHEMA).columns == ["id"]
    assert add_missing_columns(df, SCHEMA).columns == ["id", "extra", "category", "geometry"]


def test_missing_numbers_and_booleans_are_null(spark):
    schema = StructType.fromDDL("id bigint, n int, flag boolean, list array<bigint>")
    assert tuple(conform(frame(spark, "id bigint", (1,)), schema).first()) == (1, None, None, None)


def test_conform_orders_columns_and_casts(spark):
    df = frame(spark, "extra int, category string, id string", (5, "A", "12"), (6, "B", "no number"))
    found = conform(df, StructType.fromDDL("id bigint, category string"))
    assert found.columns == ["id", "category"]
    assert sorted(map(tuple, found.collect()), key=str) == [(12, "A"), (None, "B")]


def test_union_of_differing_frames(spark):
    schema = StructType.fromDDL("id bigint, category string, bal double")
    frames = [frame(spark, "id bigint, category string", (1, "A")), frame(spark, "bal float, id int", (0.5, 2))]
    assert sorted(map(tuple, union_conformed(frames, schema).collect())) == [(1, "A", None), (2, None, 0.5)]


@pytest.mark.parametrize(
    ("values", "target", "fitted"),
    [
        ([1, None, 0], pa.bool_(), [True, None, False]),
        (["1", "x", None], pa.int64(), [1, None, None]),
        (pa.array([1.7, float("nan"), 1e300]), pa.int32(), [1, None, None]),
        ([2**40, 1], pa.int32(), [None, 1]),
        (pa.array([1, 2]), pa.string(), ["1", "2"]),
        (["2020-01-31", "2020/02/01", "junk"], pa.date32(), [datetime.date(2020, 1, 31), datetime.date(2020, 2, 1), None]),
        (
            ["2020/01/31 12:34:56+01", "2020-01-31T12:34:56", "junk"],
            pa.timestamp("us", "UTC"),
            [datetime.datetime(2020, 1, 31, h, 34, 56, tzinfo=datetime.timezone.utc) for h in (11, 12)] + [None],
        ),
        ([1.256, "2", "x"], pa.decimal128(10, 2), [decimal.Decimal("1.26"), decimal.Decimal("2.00"), None]),
        ([1, 2.5, "3"], pa.float64(), [1.0, 2.5, 3.0]),
        ([1, "a", b"b", None], pa.string(), ["1", "a", "b", None]),
        (pa.nulls(2), pa.int64(), [None, None]),
    ],
)
def test_fit(values, target, fitted):
    assert fit(values, target).to_pylist() == fitted
    assert fit(values, target).type == target
