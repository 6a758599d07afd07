"""GeoPackage Binary (GPB) geometry as columns.

A GPB blob is a header followed by well-known binary::

    'G' 'P' version flags srs_id(int32) envelope(0, 4, 6 or 8 doubles) WKB

Flag bit 0 is the byte order of ``srs_id`` and the envelope, bits 1-3 say which
envelope is there. Everything but the envelope doubles is native column algebra,
so a query that does not read the envelope never leaves the JVM.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from featureframe.functions.buffers import binary_layout, doubles_at

# Envelope bytes by envelope code (flag bits 1-3)
ENVELOPE_BYTES = (0, 32, 48, 48, 64)
FIXED_BYTES = 8

HEADER_SCHEMA = StructType(
    [
        StructField("magic", StringType()),
        StructField("version", IntegerType()),
        StructField("flags", StringType()),
        StructField("srs_id", IntegerType()),
        StructField("envelope", ArrayType(DoubleType())),
    ]
)


_HEX_DIGITS = "0123456789ABCDEF"


def _byte(digits: Column, position: int) -> Column:
    """Value of the byte at a position (from 1) of hexadecimal text."""
    high, low = (F.instr(F.lit(_HEX_DIGITS), F.substring(digits, position * 2 + at, 1)) - 1 for at in (-1, 0))
    return high * 16 + low


def _header_length(digits: Column) -> Column:
    code = F.shiftright(_byte(digits, 4), 1).bitwiseAND(F.lit(7))
    sizes = F.array(*[F.lit(FIXED_BYTES + size) for size in ENVELOPE_BYTES])
    return F.get(sizes, code)


def _fixed_part(blob: Column) -> Column:
    """The first eight bytes as hexadecimal text."""
    return F.hex(F.substring(blob, 1, FIXED_BYTES))


def header_length(blob: Column) -> Column:
    """Header bytes of each blob, from its own flags (null for an invalid code)."""
    return _header_length(_fixed_part(blob))


def _length(blob: Column, fixed: int | None) -> Column:
    return header_length(blob) if fixed is None else F.lit(fixed)


def header_bytes(blob: Column, fixed_length: int | None = None) -> Column:
    """The header part of the blob."""
    return F.substring(blob, F.lit(1), _length(blob, fixed_length))


def wkb_bytes(blob: Column, fixed_length: int | None = None) -> Column:
    """The well-known binary part of the blob."""
    start = _length(blob, fixed_length)
    return F.substring(blob, start + 1, F.length(blob) - start)


def _srs_id(digits: Column) -> Column:
    swapped = F.concat(*[F.substring(digits, at, 2) for at in (15, 13, 11, 9)])
    little = _byte(digits, 4).bitwiseAND(F.lit(1)) == 1
    unsigned = F.conv(F.when(little, swapped).otherwise(F.substring(digits, 9, 8)), 16, 10).cast("bigint")
    return F.shiftright(F.shiftleft(unsigned, 32), 32).cast("int")  # two's complement


@F.arrow_udf(ArrayType(DoubleType()))
def envelope(header: pa.Array) -> pa.Array:
    """Envelope doubles ``[minx, maxx, miny, maxy, ...]`` of GPB headers.

    Null where there is no header or the header carries no envelope.
    """
    data, starts, lengths, valid = binary_layout(header)
    counts = np.where(valid, np.maximum(lengths - FIXED_BYTES, 0) // 8, 0)
    offsets = np.zeros(len(header) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    values = np.empty(int(offsets[-1]), dtype=np.float64)
    little = np.zeros(len(header), dtype=bool)
    some = counts > 0
    little[some] = data[starts[some] + 3] & 1 == 1
    for count in np.unique(counts[some]):
        for is_little, dtype in ((True, "<f8"), (False, ">f8")):
            rows = np.flatnonzero((counts == count) & (little == is_little))
            into = offsets[rows][:, None] + np.arange(count)
            values[into] = doubles_at(data, starts[rows] + FIXED_BYTES, int(count), dtype)
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(values, pa.float64()), mask=pa.array(~some)
    )


def _header_struct(header: Column, digits: Column) -> Column:
    fields = F.struct(
        F.decode(F.substring(header, 1, 2), "US-ASCII").alias("magic"),
        _byte(digits, 3).alias("version"),
        F.lpad(F.bin(_byte(digits, 4)), 8, "0").alias("flags"),
        _srs_id(digits).alias("srs_id"),
        envelope(header).alias("envelope"),
    )
    return F.when(header.isNotNull(), fields).cast(HEADER_SCHEMA)


def unpack_header(header: Column) -> Column:
    """Header bytes as ``struct(magic, version, flags, srs_id, envelope)``."""
    return _header_struct(header, _fixed_part(header))


def split_geometry(
    df: DataFrame,
    geometry_column: str = "geom",
    fixed_header_length: int | None = None,
    drop_gpb_header: bool = False,
) -> DataFrame:
    """Replace a GPB column by ``gpb_header`` (unpacked) and ``wkb_geometry``.

    Both are appended at the end. ``fixed_header_length`` forces one header
    length; by default each row's own flags decide.
    """
    blob, digits, start = F.col(f"`{geometry_column}`"), F.col("_gpb_digits"), F.col("_gpb_length")
    others = [F.col(f"`{name}`") for name in df.columns if name != geometry_column]
    # values used many times get a projection of their own, so each is computed once per row
    staged = df.withColumn("_gpb_digits", _fixed_part(blob))
    length = _header_length(digits) if fixed_header_length is None else F.lit(fixed_header_length)
    staged = staged.withColumn("_gpb_length", length)
    if drop_gpb_header:
        added = []
    else:
        staged = staged.withColumn("_gpb_header", F.substring(blob, F.lit(1), start))
        added = [_header_struct(F.col("_gpb_header"), digits).alias("gpb_header")]
    wkb = F.substring(blob, start + 1, F.length(blob) - start).alias("wkb_geometry")
    return staged.select(*others, *added, wkb)
