"""Well-known binary of a whole batch of geometries at once.

Geometries are parts in the order they are written: a geometry is one part, a collection is
a part of its own with its members after it. Every part holds areas, areas hold lines, lines
hold points, told by offsets as in Arrow lists; kinds of geometry with fewer levels have one
area or one line. Sizes add up from points to parts, places follow from parts to points, and
headers, counts and coordinates are then put where they belong, each in one go.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from featureframe.functions import wkb

# Bytes before the areas of a part, the lines of an area and the points of a line, by WKB type
#                         -  POINT LINE POLYGON M.POINT M.LINE M.POLYGON COLLECTION
_BEFORE_AREAS = np.array([0, 5, 5, 5, 9, 9, 9, 9])
_BEFORE_LINES = np.array([0, 0, 0, 4, 0, 0, 9, 0])
_BEFORE_POINTS = np.array([0, 0, 4, 4, 0, 9, 4, 0])


class Parts(NamedTuple):
    """Parts of geometries in writing order; rows without a part are null."""

    #: Row of each part, ascending.
    row: np.ndarray
    #: Number of collections it is inside.
    depth: np.ndarray
    #: WKB type code without flags.
    kind: np.ndarray
    #: Offsets of each part's areas, each area's lines, each line's points.
    areas: np.ndarray
    lines: np.ndarray
    points: np.ndarray
    #: Coordinates of each point, and whether it has the third.
    xyz: np.ndarray
    has_z: np.ndarray


def offsets_of(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def _owners(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(offsets_of(values)[offsets])


def _places(start: np.ndarray, sizes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each inner item begins: one after the other from the ``start`` of its owner's items."""
    before = offsets_of(sizes)
    return np.repeat(start - before[offsets[:-1]], np.diff(offsets)) + before[:-1]


def _of_collections(parts: Parts, written: np.ndarray, has_z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of direct members of each part that is a collection, and whether any part inside has a third coordinate."""
    members, z = np.zeros(len(parts.kind), np.int64), has_z.copy()
    found = np.flatnonzero(parts.kind == wkb.COLLECTION)
    inside_z = offsets_of(has_z)
    for depth in np.unique(parts.depth[found]):  # as many as collections are nested
        own = found[parts.depth[found] == depth]
        ends = np.append(np.flatnonzero(parts.depth <= depth), len(parts.depth))
        end = ends[np.searchsorted(ends, own, side="right")]
        direct = offsets_of((parts.depth == depth + 1) & written)
        members[own] = direct[end] - direct[own + 1]
        z[own] = inside_z[end] > inside_z[own]
    return members, z


class _Bytes:
    def __init__(self, size: int):
        self.out = np.zeros(size, np.uint8)

    def put(self, at: np.ndarray, values: np.ndarray) -> None:
        """The bytes of each row of ``values`` from each place on."""
        if len(at):
            rows = np.ascontiguousarray(values).view(np.uint8).reshape(len(at), -1)
            self.out[at[:, None] + np.arange(rows.shape[1])] = rows

    def header(self, at: np.ndarray, kind, has_z: np.ndarray) -> None:
        self.out[at] = 1
        self.put(at + 1, (np.broadcast_to(kind, at.shape) | np.where(has_z, wkb.Z_FLAG, 0)).astype("<u4"))

    def count(self, at: np.ndarray, number: np.ndarray) -> None:
        self.put(at, number.astype("<u4"))


def assemble(parts: Parts, rows: int) -> pa.Array:
    """WKB of ``rows`` geometries. Empty points are left out; a row with nothing else is null."""
    kind = parts.kind
    area_part, line_area, point_line = _owners(parts.areas), _owners(parts.lines), _owners(parts.points)
    line_part = area_part[line_area]
    point_part = line_part[point_line]
    n_points = np.bincount(point_part, minlength=len(kind))
    written = (kind != wkb.POINT) | (n_points > 0)
    members, has_z = _of_collections(parts, written, np.bincount(point_part[parts.has_z], minlength=len(kind)) > 0)

    many_points = kind == wkb.MULTIPOINT
    point_size = 16 + 8 * has_z + 5 * many_points
    line_size = _BEFORE_POINTS[kind[line_part]] + np.diff(parts.points) * point_size[line_part]
    area_size = _BEFORE_LINES[kind[area_part]] + _sums(line_size, parts.lines)
    before_areas = _BEFORE_AREAS[kind] * written
    part_size = before_areas + _sums(area_size, parts.areas)
    part_at = offsets_of(part_size)
    area_at = _places(part_at[:-1] + before_areas, area_size, parts.areas)
    line_at = _places(area_at + _BEFORE_LINES[kind[area_part]], line_size, parts.lines)
    point_at = _places(line_at + _BEFORE_POINTS[kind[line_part]], point_size[point_part], parts.points)

    out, part_at = _Bytes(part_at[-1]), part_at[:-1]
    out.header(part_at[written], kind[written], has_z[written])
    for outer, number in ((wkb.MULTIPOINT, n_points), (wkb.MULTIPOLYGON, np.diff(parts.areas)), (wkb.COLLECTION, members)):
        out.count(part_at[kind == outer] + 5, number[kind == outer])
    own = kind == wkb.MULTILINESTRING
    out.count(part_at[own] + 5, _sums(np.diff(parts.lines), parts.areas)[own])
    rings = np.diff(parts.lines)
    for outer, own in ((wkb.POLYGON, kind[area_part] == wkb.POLYGON), (wkb.MULTIPOLYGON, kind[area_part] == wkb.MULTIPOLYGON)):
        ahead = 5 * (outer == wkb.MULTIPOLYGON)
        if ahead:
            out.header(area_at[own], wkb.POLYGON, has_z[area_part[own]])
        out.count(area_at[own] + ahead, rings[own])
    own = kind[line_part] == wkb.MULTILINESTRING
    out.header(line_at[own], wkb.LINESTRING, has_z[line_part[own]])
    own = _BEFORE_POINTS[kind[line_part]] > 0
    out.count(line_at[own] + 5 * (kind[line_part[own]] == wkb.MULTILINESTRING), np.diff(parts.points)[own])
    own = many_points[point_part]
    out.header(point_at[own], wkb.POINT, has_z[point_part[own]])
    xyz, at = parts.xyz.astype("<f8"), point_at + 5 * own
    out.put(at, xyz[:, :2])
    third = has_z[point_part]
    out.put(at[third] + 16, xyz[third, 2])

    sizes = np.bincount(parts.row, weights=part_size, minlength=rows).astype(np.int64)
    valid = np.bincount(parts.row[written], minlength=rows) > 0
    buffers = [np.packbits(valid, bitorder="little"), offsets_of(sizes).astype(np.int32), out.out]
    return pa.Array.from_buffers(pa.binary(), rows, [pa.py_buffer(buffer.tobytes()) for buffer in buffers])
