"""Text geometries (GeoJSON objects, GML elements) to well-known binary.

Spark parses: JSON into nested lists of numbers, GML into its sequence of geometry tags and
lists of numbers. What is left is arithmetic on the offsets of whole Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from featureframe.functions import wkb
from featureframe.functions.assemble import Parts, assemble, offsets_of

# GeoJSON geometry names -> WKB type codes
CODES = {
    "Point": wkb.POINT,
    "LineString": wkb.LINESTRING,
    "Polygon": wkb.POLYGON,
    "MultiPoint": wkb.MULTIPOINT,
    "MultiLineString": wkb.MULTILINESTRING,
    "MultiPolygon": wkb.MULTIPOLYGON,
    "GeometryCollection": wkb.COLLECTION,
}
# How deep positions are nested in coordinates
_DEPTH = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}
_OBJECT = "struct<type string, coordinates string, geometries string>"
_AREAS = "array<array<array<array<double>>>>"
#: Collections inside collections that are read.
MOST_NESTED = 3

# GML geometry elements -> WKB type codes
_ELEMENTS = {
    "Point": wkb.POINT,
    "LineString": wkb.LINESTRING,
    "Curve": wkb.LINESTRING,
    "Polygon": wkb.POLYGON,
    "Surface": wkb.POLYGON,
    "MultiPoint": wkb.MULTIPOINT,
    "MultiLineString": wkb.MULTILINESTRING,
    "MultiCurve": wkb.MULTILINESTRING,
    "MultiPolygon": wkb.MULTIPOLYGON,
    "MultiSurface": wkb.MULTIPOLYGON,
    "MultiGeometry": wkb.COLLECTION,
}
# Rings of an area, and elements that hold numbers
_RINGS, _NUMBERS = ("LinearRing", "Ring"), ("pos", "posList", "coordinates")
_NAMES = [*_ELEMENTS, *_RINGS, *_NUMBERS]
_KIND = np.array([*_ELEMENTS.values(), *[0] * 5])
_TAG = rf"<(/?)(?:[\w.-]+:)?({'|'.join(_NAMES)})(?=[\s/>])([^>]*)>([^<]*)"
_COMMENT, _CDATA = r"(?s)<!--.*?-->", r"(?s)<!\[CDATA\[(.*?)\]\]>"
# EPSG codes whose axes are latitude, longitude in URN spelling
_LATITUDE_FIRST = ("4326", "4258", "4269", "4277", "4230", "4171")
_URN = r"urn:(?:x-)?ogc:def:crs:EPSG:[^:]*:(\d+)|http://www\.opengis\.net/def/crs/EPSG/0/(\d+)"


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.transform(F.array(value), lambda one: use(one))[0]


def _areas(geometry: Column) -> Column:
    """Coordinates of any kind but collections as areas of lines of positions."""
    text = geometry["coordinates"]
    found = F.when(text.isNull(), F.raise_error(F.concat(F.lit("GeoJSON without coordinates: "), geometry["type"])))
    for name, depth in _DEPTH.items():
        kind = "array<" * (depth + 1) + "double" + ">" * (depth + 1)

        def nested(listed: Column, depth: int = depth) -> Column:
            whole = listed
            for _ in range(3 - depth):
                whole = F.array(whole)
            # a point without coordinates is empty
            return F.when(F.size(listed) == 0, F.array().cast(_AREAS)).when(listed.isNotNull(), whole) if depth == 0 else whole

        # outside the lambda, which may not use what is bound around it
        bad = F.raise_error(F.concat(F.lit("GeoJSON coordinates cannot be read: "), F.substring(text, 1, 200)))
        listed = F.from_json(text, kind)
        found = found.when(geometry["type"] == name, F.coalesce(_once(listed, nested) if depth == 0 else nested(listed), bad))
    return found.cast(_AREAS)


def _parts(geometry: Column, depth: int = 0) -> Column:
    """``depth, kind, areas`` of a geometry object, and of its members after it."""
    kind = geometry["type"]
    codes = F.create_map(*(F.lit(one) for pair in CODES.items() for one in pair))
    own = lambda areas: F.array(F.struct(F.lit(depth).alias("depth"), codes[kind].alias("kind"), areas.alias("areas")))
    if depth < MOST_NESTED:
        members = F.from_json(geometry["geometries"], f"array<{_OBJECT}>")
        inner = F.flatten(F.transform(members, lambda member: _parts(member, depth + 1)))
        collection = F.concat(own(F.lit(None).cast(_AREAS)), F.coalesce(inner, F.raise_error(F.lit("A GeometryCollection without geometries"))))
    else:
        collection = F.raise_error(F.lit(f"GeoJSON collections are nested more than {MOST_NESTED} deep"))
    unknown = F.raise_error(F.concat(F.lit("Unknown GeoJSON geometry type "), F.coalesce(kind, F.lit("null"))))
    return F.when(kind == "GeometryCollection", collection).when(kind.isin(*_DEPTH), own(_areas(geometry))).otherwise(unknown)


def geojson_wkb(text: Column) -> Column:
    """WKB of GeoJSON geometry objects; null for null and for empty points.

    Positions of one or more than three numbers are filled with zeros or cut.
    """
    return _geojson_parts_wkb(F.when(text.isNotNull(), _once(F.from_json(text, _OBJECT), _parts)))


def _below(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets of lists, and what they hold."""
    return offsets_of(lists.value_lengths().fill_null(0).to_numpy()), lists.flatten()


def _listed(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    if lists.null_count:
        raise ValueError("GeoJSON coordinates hold something else than numbers.")
    return _below(lists)


@F.arrow_udf(BinaryType())
def _geojson_parts_wkb(parts: pa.Array) -> pa.Array:
    of_rows, every = _below(parts)
    areas, below = _below(every.field("areas"))
    lines, below = _listed(below)
    points, below = _listed(below)
    numbers, values = _listed(below)
    if values.null_count:
        raise ValueError("GeoJSON coordinates hold something else than numbers.")
    xyz, has_z = _positions(values.to_numpy(), numbers[:-1], np.diff(numbers))
    depth, kind = (every.field(name).to_numpy() for name in ("depth", "kind"))
    row = np.repeat(np.arange(len(parts)), np.diff(of_rows))
    return assemble(Parts(row, depth, kind, areas, lines, points, xyz, has_z), len(parts))


def _positions(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three coordinates of each position from ``start`` on, missing ones 0, and whether it has the third."""
    padded = np.append(values.astype(np.float64), 0.0)
    there = np.arange(3) < size[:, None]
    return padded[np.where(there, start[:, None] + np.arange(3), len(values))], size > 2


def gml_wkb(text: Column) -> Column:
    """WKB of GML geometry elements, whatever their namespace prefix; null for null and for empty points.

    Axes are turned to x, y where the first ``srsName`` is a URN of a system with latitude first.
    """
    plain = F.regexp_replace(F.regexp_replace(text, _COMMENT, ""), _CDATA, "$1")
    group = lambda n: F.regexp_extract_all(plain, F.lit(_TAG), F.lit(n))
    tags = F.arrays_zip(*(group(n + 1).alias(name) for n, name in enumerate(("slash", "name", "more", "text"))))
    srs = F.regexp_extract(plain, r"""srsName\s*=\s*["']([^"']*)""", 1)
    code = F.concat(F.regexp_extract(srs, _URN, 1), F.regexp_extract(srs, _URN, 2))

    def described(tag: Column) -> Column:
        inner = F.btrim(tag["text"], F.lit(" \t\r\n"))
        has_numbers = (tag["slash"] == "") & tag["name"].isin(*_NUMBERS) & (inner != "")
        numbers = F.when(has_numbers, F.split(inner, r"[\s,]+").cast("array<double>"))
        width = F.when(tag["name"] == "coordinates", F.size(F.split(F.split(inner, r"\s+")[0], ","))).otherwise(
            F.regexp_extract(tag["more"], r"""srsDimension\s*=\s*["']\s*(\d+)""", 1).try_cast("int")
        )
        return F.struct(
            (F.array_position(F.array(*map(F.lit, _NAMES)), tag["name"]) - 1).cast("int").alias("name"),
            (tag["slash"] == "/").alias("closes"),
            ((tag["slash"] == "/") | F.endswith(tag["more"], F.lit("/"))).alias("shut"),
            width.alias("width"),
            numbers.alias("numbers"),
        )

    swap = F.coalesce(code.isin(*_LATITUDE_FIRST), F.lit(False))
    return _gml_tags_wkb(F.transform(tags, described), swap)


@F.arrow_udf(BinaryType())
def _gml_tags_wkb(tags: pa.Array, swap: pa.Array) -> pa.Array:
    of_rows, every = _below(tags)
    row = np.repeat(np.arange(len(tags)), np.diff(of_rows))
    name = every.field("name").to_numpy()
    closes, shut = (every.field(one).to_numpy(zero_copy_only=False) for one in ("closes", "shut"))
    numbers, values = _below(every.field("numbers"))
    parts, area, line, depth = _structure(row, name, closes, shut)
    part_of, area_of, line_of = (np.cumsum(one) - 1 for one in (parts, area, line))

    held = np.diff(numbers)
    positions = np.flatnonzero(held > 0)
    positions = positions[line_of[positions] >= 0]
    of_line = np.flatnonzero(line)[line_of[positions]]
    positions = positions[part_of[of_line] == part_of[positions]]  # others are in no line
    width = _widths(every.field("width"), row, name, closes, held)[positions]
    if (held[positions] % width).any():
        raise ValueError("A GML list of numbers does not hold whole positions.")
    repeats = held[positions] // width
    owner, width = np.repeat(positions, repeats), np.repeat(width, repeats)
    nth = np.arange(len(owner)) - np.repeat(offsets_of(repeats)[:-1], repeats)
    xyz, has_z = _positions(values.to_numpy(), numbers[owner] + nth * width, width)
    turned = swap.to_numpy(zero_copy_only=False)[row[owner]]
    xyz[turned, :2] = xyz[turned, 1::-1]
    # a point is its first position
    kind = _KIND[name[parts]]
    first = np.append(True, line_of[owner][1:] != line_of[owner][:-1])[: len(owner)]
    kept = first | (kind[part_of[owner]] != wkb.POINT)
    owner, xyz, has_z = owner[kept], xyz[kept], has_z[kept]

    count = lambda owners, number: offsets_of(np.bincount(owners, minlength=number))
    areas, lines = count(part_of[area], parts.sum()), count(area_of[line], area.sum())
    found = Parts(row[parts], depth[parts], kind, areas, lines, count(line_of[owner], line.sum()), xyz, has_z)
    return assemble(found, len(tags))


def _structure(row: np.ndarray, name: np.ndarray, closes: np.ndarray, shut: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which tags begin a part, an area, a line, and how many geometries each is inside."""
    kind = _KIND[name]
    shape, begins = kind > 0, ~closes
    steps = np.where(shape & begins & ~shut, 1, 0) - np.where(shape & closes, 1, 0)
    after = np.cumsum(steps)
    depth = after - np.maximum(steps, 0)
    ends = np.flatnonzero(np.append(row[1:] != row[:-1], True)[: len(row)])
    if after[ends].any() or (after < 0).any():
        raise ValueError("GML geometry elements are not closed in order.")
    opened = shape & begins
    parent = np.zeros(len(name), np.int64)  # the kind of the element around, 0 for none
    for level in range(1, int(depth.max(initial=0)) + 1):  # as many as elements are nested
        own, around = np.flatnonzero(opened & (depth == level)), np.flatnonzero(opened & ~shut & (depth == level - 1))
        parent[own] = kind[around[np.searchsorted(around, own) - 1]]
    parts = opened & ((depth == 0) | (parent == wkb.COLLECTION))
    ring = np.isin(name, [_NAMES.index(one) for one in _RINGS]) & begins
    of_many_lines = opened & (parent == wkb.MULTILINESTRING) & (kind == wkb.LINESTRING)
    of_many_areas = opened & (parent == wkb.MULTIPOLYGON) & (kind == wkb.POLYGON)
    plain = parts & (kind != wkb.COLLECTION)
    area = (plain & (kind != wkb.MULTIPOLYGON)) | of_many_areas
    in_area = np.isin(kind[np.maximum.accumulate(np.where(parts, np.arange(len(name)), 0))], (wkb.POLYGON, wkb.MULTIPOLYGON)) if len(name) else ring
    line = (plain & np.isin(kind, (wkb.POINT, wkb.LINESTRING, wkb.MULTIPOINT))) | of_many_lines | (ring & in_area)
    return parts, area, line, depth


def _widths(own: pa.Array, row: np.ndarray, name: np.ndarray, closes: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Numbers to a position: all of a ``pos``, else what the element says or one before it, else two."""
    width = pc.fill_null(own, 0).to_numpy()
    says = (_KIND[name] > 0) & ~closes & (width > 0)
    last = np.maximum.accumulate(np.where(says, np.arange(len(name)), -1)) if len(name) else np.empty(0, np.int64)
    inherited = np.where((last >= 0) & (row[last] == row), width[last], 2)
    return np.where(name == _NAMES.index("pos"), held, np.where(width > 0, width, inherited))
