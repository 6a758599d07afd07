"""Well-known binary: point encoding, coordinates, bounds, byte-order clean-up."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StructField, StructType

from featureframe.functions.buffers import binary_layout, doubles_at, fixed_width_binary, gather

# WKB geometry type codes
POINT, LINESTRING, POLYGON = 1, 2, 3
MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, COLLECTION = 4, 5, 6, 7
CIRCULARSTRING = 8
Z_FLAG = 0x80000000
POINT_BYTES = 21


def encode_points(x: np.ndarray, y: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Little-endian 2D point WKB for every (x, y); null where not valid."""
    rows = np.zeros(len(x), dtype=[("order", "u1"), ("code", "<u4"), ("x", "<f8"), ("y", "<f8")])
    rows["order"], rows["code"], rows["x"], rows["y"] = 1, POINT, x, y
    return fixed_width_binary(rows.view(np.uint8).reshape(len(x), POINT_BYTES), valid)


@F.arrow_udf(BinaryType())
def point_wkb(x: pa.Array, y: pa.Array) -> pa.Array:
    """WKB point from two coordinate columns; null where either is null."""
    valid = x.is_valid().to_numpy(zero_copy_only=False) & y.is_valid().to_numpy(zero_copy_only=False)
    filled = (x.fill_null(0.0).to_numpy(), y.fill_null(0.0).to_numpy())
    return encode_points(*filled, valid)


def type_code(base: int, has_z: bool, has_m: bool = False) -> int:
    """WKB type code: Z by the high flag for the simple types, otherwise ISO thousands."""
    if has_m:
        return base + (3000 if has_z else 2000)
    if has_z:
        return base + 1000 if base > COLLECTION else base | Z_FLAG
    return base


def _read_code(wkb: bytes, at: int) -> tuple[str, int, int, bool, bool]:
    order = "<" if wkb[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", wkb, at + 1)
    has_z = bool(code & 0x80000000) or (code & 0xFFFF) // 1000 in (1, 3)
    has_m = bool(code & 0x40000000) or (code & 0xFFFF) // 1000 in (2, 3)
    return order, (code & 0xFFFF) % 1000, 2 + has_z + has_m, has_z, has_m


def _walk(wkb: bytes, at: int, parts: list[bytes], runs: list[np.ndarray]) -> int:
    """Append the little-endian bytes of the geometry at ``at`` to ``parts`` and
    its coordinates to ``runs``; returns the position after it."""
    order, base, width, has_z, has_m = _read_code(wkb, at)
    at += 5
    parts.append(struct.pack("<BI", 1, type_code(base, has_z, has_m)))

    def count(position: int) -> int:
        (number,) = struct.unpack_from(order + "I", wkb, position)
        parts.append(struct.pack("<I", number))
        return number

    def coordinates(position: int, points: int) -> int:
        values = np.frombuffer(wkb, order + "f8", points * width, position).astype("<f8")
        parts.append(values.tobytes())
        runs.append(values.reshape(points, width)[:, :2])
        return position + points * width * 8

    if base == POINT:
        return coordinates(at, 1)
    number = count(at)
    at += 4
    if base in (LINESTRING, CIRCULARSTRING):
        return coordinates(at, number)
    if base in (POLYGON, 17):
        for _ in range(number):
            points = count(at)
            at = coordinates(at + 4, points)
        return at
    for _ in range(number):
        at = _walk(wkb, at, parts, runs)
    return at


def little_endian(wkb: bytes) -> bytes:
    """The same geometry with every part little-endian and flagged-Z type codes."""
    plain = wkb[0] == 1 and wkb[2:5] == b"\0\0\0"  # little-endian and 2D
    if plain and not (MULTIPOINT <= wkb[1] <= COLLECTION and wkb[9:10] == b"\0"):
        return wkb
    parts: list[bytes] = []
    _walk(wkb, 0, parts, [])
    return b"".join(parts)


def _bounds(wkb: bytes) -> list[float]:
    runs: list[np.ndarray] = []
    _walk(wkb, 0, [], runs)
    points = np.concatenate(runs) if runs else np.empty((0, 2))
    points = points[~np.isnan(points).any(axis=1)]
    if not len(points):
        return [np.nan] * 4
    (min_x, min_y), (max_x, max_y) = points.min(axis=0), points.max(axis=0)
    return [min_x, max_x, min_y, max_y]


def _plain_points(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, valid: np.ndarray) -> np.ndarray:
    plain = valid & (lengths == POINT_BYTES)
    rows = np.flatnonzero(plain)
    plain[rows] = (data[starts[rows]] == 1) & (data[starts[rows] + 1] == POINT)
    return plain


# a batch goes geometry by geometry once so few of them have parts left
_FEW = 8


def corners(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """``minx, maxx, miny, maxy`` of each geometry in ``data``, not numbers for null or empty ones.

    All geometries of a batch are walked at once, a line, ring or point of each at a time.
    """
    found = np.full((len(starts), 4), np.nan)
    plain = _plain_points(data, starts, lengths, valid)
    found[plain] = np.repeat(doubles_at(data, starts[plain] + 5, 2, "<f8"), 2, axis=1)
    rows = np.flatnonzero(valid & ~plain & (lengths >= 5))
    alone = [rows[data[starts[rows]] != 1]]  # the other byte order
    rows = rows[data[starts[rows]] == 1]
    at, runs = starts[rows].copy(), []
    parts, rings, width = np.ones(len(rows), np.int64), np.zeros(len(rows), np.int64), np.full(len(rows), 2)
    while len(rows) > _FEW:
        heads = np.flatnonzero(rings == 0)
        code = gather(data, at[heads] + 1, 4).view("<u4").ravel()
        thousands = (code & 0xFFFF) // 1000
        width[heads] = 2 + (code & 0x80000000 != 0).astype(int) + (code & 0x40000000 != 0) + np.array([0, 1, 1, 2])[np.minimum(thousands, 3)]
        base = np.zeros(len(rows), np.int64)
        base[heads] = (code & 0xFFFF) % 1000
        at[heads] += 5
        number = np.ones(len(rows), np.int64)
        counted = base != POINT
        number[counted] = gather(data, at[counted], 4).view("<u4").ravel()
        at[counted] += 4
        is_area = (base == POLYGON) | (base == 17)
        is_run = (rings > 0) | np.isin(base, (POINT, LINESTRING, CIRCULARSTRING))
        runs.append(np.stack([rows, at, number, width])[:, is_run])
        at[is_run] += (8 * number * width)[is_run]
        # members of a collection follow it, so they only add to what is left
        parts += np.where(is_run | is_area, 0, number - 1)
        ended = np.where(rings > 0, rings == 1, is_run | (is_area & (number == 0)))
        rings = np.where(rings > 0, rings - 1, np.where(is_area, number, 0))
        parts -= ended
        left = parts > 0
        rows, at, parts, rings, width = (one[left] for one in (rows, at, parts, rings, width))
    if runs:
        _bound_runs(found, data, np.concatenate(runs, axis=1))
    for row in np.concatenate([*alone, rows]).tolist():
        found[row] = _bounds(data[starts[row] : starts[row] + lengths[row]].tobytes())
    found[np.isnan(found).any(axis=1)] = np.nan
    return found


def _bound_runs(found: np.ndarray, data: np.ndarray, runs: np.ndarray) -> None:
    """Puts the bounds of runs of points (row, place, points, width) into their rows."""
    row, at, number, width = runs[:, np.lexsort((runs[1], runs[0]))]
    places = np.repeat(at - 8 * width * (np.cumsum(number) - number), number) + 8 * np.arange(number.sum()) * np.repeat(width, number)
    if not len(places):
        return
    xy = doubles_at(data, places, 2, "<f8")
    owner = np.repeat(row, number)
    whole = ~np.isnan(xy).any(axis=1)
    owner, xy = owner[whole], xy[whole]
    if not len(owner):
        return
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    low, high = np.minimum.reduceat(xy, first), np.maximum.reduceat(xy, first)
    found[owner[first]] = np.stack([low[:, 0], high[:, 0], low[:, 1], high[:, 1]], axis=1)


@F.arrow_udf(ArrayType(DoubleType()))
def wkb_bounds(wkb: pa.Array) -> pa.Array:
    """``[minx, maxx, miny, maxy]`` of each geometry; null for null or empty ones."""
    found = corners(*binary_layout(wkb))
    offsets = pa.array(np.arange(len(wkb) + 1, dtype=np.int32) * 4)
    return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()), mask=pa.array(np.isnan(found).any(axis=1)))


@F.arrow_udf(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))
def wkb_xy(wkb: pa.Array) -> pa.Array:
    """Coordinates of point geometries; null for anything that is not a point."""
    data, starts, lengths, valid = binary_layout(wkb)
    plain = _plain_points(data, starts, lengths, valid)
    xy = np.zeros((len(plain), 2))
    rows = np.flatnonzero(plain)
    xy[rows] = doubles_at(data, starts[rows] + 5, 2, "<f8")
    for row in np.flatnonzero(valid & ~plain):
        value = wkb[int(row)].as_py()
        order, base, _, _, _ = _read_code(value, 0)
        if base == POINT:
            xy[row], plain[row] = struct.unpack_from(order + "2d", value, 5), True
    columns = [pa.array(xy[:, 0]), pa.array(xy[:, 1])]
    return pa.StructArray.from_arrays(columns, ["x", "y"], mask=pa.array(~plain))
