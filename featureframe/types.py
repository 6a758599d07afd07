"""Type tables: vector attribute types and SQLite declared types to Spark types."""

from __future__ import annotations

from collections.abc import Collection
from enum import Enum
from types import MappingProxyType

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)


class ConcurrencyStrategy(Enum):
    """How a read is split into tasks."""

    FILES = "files"
    ROWS = "rows"


# OGR (field type, field subtype) -> Spark type. The two list
# subtypes follow their scalar counterparts: subtype 1 is boolean, 2 is int16.
OGR_TO_SPARK = MappingProxyType(
    {
        (0, 0): IntegerType(),
        (0, 1): BooleanType(),
        (0, 2): ShortType(),
        (1, 0): ArrayType(IntegerType()),
        (1, 1): ArrayType(BooleanType()),
        (1, 2): ArrayType(ShortType()),
        (2, 0): DoubleType(),
        (2, 3): FloatType(),
        (3, 0): ArrayType(DoubleType()),
        (3, 3): ArrayType(FloatType()),
        (4, 0): StringType(),
        (4, 4): StringType(),
        (4, 5): StringType(),
        (5, 0): ArrayType(StringType()),
        (6, 0): StringType(),
        (7, 0): ArrayType(StringType()),
        (8, 0): BinaryType(),
        (9, 0): StringType(),
        (10, 0): StringType(),
        (11, 0): StringType(),
        (12, 0): LongType(),
        (13, 0): ArrayType(LongType()),
    }
)

# SQLite declared type -> Spark type name, as a GeoPackage table
# shows them when it is read as a plain table.
SQLITE_TO_SPARK = MappingProxyType(
    {
        "BOOLEAN": "boolean",
        "TINYINT": "tinyint",
        "SMALLINT": "smallint",
        "MEDIUMINT": "int",
        "INT": "bigint",
        "INTEGER": "bigint",
        "FLOAT": "float",
        "DOUBLE": "double",
        "REAL": "double",
        "TEXT": "string",
        "BLOB": "binary",
        "GEOMETRY": "binary",
        "POINT": "binary",
        "LINESTRING": "binary",
        "POLYGON": "binary",
        "MULTIPOINT": "binary",
        "MULTILINESTRING": "binary",
        "MULTIPOLYGON": "binary",
        "GEOMETRYCOLLECTION": "binary",
        "CIRCULARSTRING": "binary",
        "COMPOUNDCURVE": "binary",
        "CURVEPOLYGON": "binary",
        "MULTICURVE": "binary",
        "MULTISURFACE": "binary",
        "CURVE": "binary",
        "SURFACE": "binary",
        "DATE": "date",
        "DATETIME": "string",
    }
)

# SQLite declared type -> OGR (type, subtype), as a GeoPackage
# layer shows them when it is read as a vector layer.
SQLITE_TO_OGR = MappingProxyType(
    {
        "BOOLEAN": (0, 1),
        "TINYINT": (0, 0),
        "SMALLINT": (0, 2),
        "MEDIUMINT": (0, 0),
        "INT": (12, 0),
        "INTEGER": (12, 0),
        "FLOAT": (2, 3),
        "DOUBLE": (2, 0),
        "REAL": (2, 0),
        "NUMERIC": (2, 0),
        "TEXT": (4, 0),
        "BLOB": (8, 0),
        "DATE": (9, 0),
        "DATETIME": (11, 0),
    }
)


def base_declared_type(declared: str) -> str:
    """``TEXT(20)`` -> ``TEXT``."""
    return declared.split("(")[0].strip().upper()


def sqlite_spark_type(declared: str) -> str:
    """Spark type name of one declared type; unknown names read as string."""
    return SQLITE_TO_SPARK.get(base_declared_type(declared), "string")


#: Numbers and truth values, each type with room for all before it but for large integers in ``double``.
_WIDENING = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double")


def wider_type(types: Collection[str], name: str = "") -> str:
    """A type that holds values of all of ``types``: the widest number, else text; blobs hold text too."""
    kinds = set(types)
    if len(kinds) == 1:
        return next(iter(kinds))
    if "binary" in kinds:
        if kinds <= {"binary", "string"}:
            return "binary"
        raise ValueError(f"The column {name} has values of {sorted(kinds)}, which no type holds.")
    if not kinds <= set(_WIDENING) or (len(kinds) > 1 and "boolean" in kinds):
        return "string"
    widest = max(kinds, key=_WIDENING.index)
    return "double" if widest == "float" else widest


def sqlite_ogr_type(declared: str) -> tuple[int, int]:
    """OGR (type, subtype) of one declared type; unknown names read as string."""
    return SQLITE_TO_OGR.get(base_declared_type(declared), (4, 0))


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in pairs.items() for part in pair])


def declared_type_column(declared: Column) -> Column:
    """Column form of :func:`sqlite_spark_type`."""
    base = F.upper(F.trim(F.substring_index(declared, "(", 1)))
    return F.coalesce(F.try_element_at(_literal_map(dict(SQLITE_TO_SPARK)), base), F.lit("string"))


def ogr_type_column(
    ogr_type: Column,
    ogr_subtype: Column,
    type_map: dict[tuple[int, int], DataType] = OGR_TO_SPARK,
) -> Column:
    """Spark type name of an (OGR type, subtype) pair; null where the map has no entry."""
    names = {f"{t},{s}": spark_type.simpleString() for (t, s), spark_type in type_map.items()}
    key = F.concat_ws(",", ogr_type.cast("string"), ogr_subtype.cast("string"))
    return F.try_element_at(_literal_map(names), key)
