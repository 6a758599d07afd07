"""Schema inference and conforming of DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from featureframe.types import OGR_TO_SPARK


def layer_schema(
    attributes: Iterable,
    type_map: Mapping[tuple[int, int], DataType] = OGR_TO_SPARK,
    geom_field_name: str = "geometry",
    geom_field_type: tuple[int, int] = (8, 0),
) -> StructType:
    """Attributes in layer order, then the geometry. An unmapped type raises ``KeyError``."""
    fields = [StructField(a["name"], type_map[a["ogr_type"], a["ogr_subtype"]]) for a in attributes]
    return StructType([*fields, StructField(geom_field_name, type_map[geom_field_type])])


def missing_fields(df: DataFrame, schema: StructType) -> list[StructField]:
    """Fields of the schema the DataFrame does not have."""
    return [field for field in schema.fields if field.name not in df.columns]


def additional_columns(df: DataFrame, schema: StructType) -> list[str]:
    """Columns of the DataFrame the schema does not have."""
    return [name for name in df.columns if name not in schema.names]


def add_missing_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Append the schema's missing fields as typed nulls."""
    added = [F.lit(None).cast(field.dataType).alias(field.name) for field in missing_fields(df, schema)]
    return df.select("*", *added)


def drop_additional_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Keep only columns the schema has; a projection the scan below can prune by."""
    return df.drop(*additional_columns(df, schema))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's fields, in its order and types; impossible casts give null."""

    def column(field: StructField) -> Column:
        found = F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None)
        return found.try_cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def union_conformed(frames: Iterable[DataFrame], schema: StructType) -> DataFrame:
    """One DataFrame from frames with differing columns."""
    return reduce(DataFrame.unionByName, [conform(frame, schema) for frame in frames])
