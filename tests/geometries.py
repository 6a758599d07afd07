"""Text geometries to well-known binary one by one, and random ones: what the batch-wise functions are held against."""

from __future__ import annotations

import json
import random
import re
import struct
import xml.etree.ElementTree as ElementTree
from itertools import chain

from featureframe.functions import wkb

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
# nesting of coordinate lists below one position
_DEPTH = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}
# EPSG codes whose axes are latitude, longitude in URN spelling
_LATITUDE_FIRST = {"4326", "4258", "4269", "4277", "4230", "4171"}
_PREFIX = re.compile(r"(</?|\s)[\w.-]+:(?=[\w.-]+[\s=/>])")
_OPENING = re.compile(r"<([\w.-]+:)?")
_URN = re.compile(r"urn:(?:x-)?ogc:def:crs:EPSG:[^:]*:(\d+)|http://www\.opengis\.net/def/crs/EPSG/0/(\d+)")


def _positions(coordinates: list, depth: int) -> list:
    for _ in range(depth - 1):
        coordinates = list(chain.from_iterable(coordinates))
    return coordinates if depth else [coordinates]


def encode(kind: str, coordinates: list) -> bytes | None:
    """WKB of a geometry given as nested coordinate lists; an empty point is null."""
    positions = _positions(coordinates, _DEPTH[kind])
    size = 3 if any(len(position) > 2 for position in positions) else 2
    if kind == "Point" and not coordinates:
        return None
    return _encode(kind, coordinates, size)


def _encode(kind: str, coordinates: list, size: int) -> bytes:
    head = struct.pack("<BI", 1, wkb.type_code(CODES[kind], size == 3))

    def run(positions: list) -> bytes:
        padded = [(*position[:size], *[0.0] * (size - len(position))) for position in positions]
        return struct.pack(f"<{len(padded) * size}d", *chain.from_iterable(padded))

    if kind == "Point":
        return head + run([coordinates])
    head += struct.pack("<I", len(coordinates))
    if kind == "LineString":
        return head + run(coordinates)
    if kind == "Polygon":
        return head + b"".join(struct.pack("<I", len(ring)) + run(ring) for ring in coordinates)
    return head + b"".join(_encode(kind.removeprefix("Multi"), part, size) for part in coordinates)


def geojson_to_wkb(text: str | None) -> bytes | None:
    geometry = json.loads(text) if text else None
    return _from_object(geometry) if geometry else None


def _from_object(geometry: dict) -> bytes | None:
    if geometry["type"] != "GeometryCollection":
        return encode(geometry["type"], geometry["coordinates"])
    parts = [part for part in map(_from_object, geometry["geometries"]) if part]
    has_z = any(struct.unpack_from("<I", part, 1)[0] & wkb.Z_FLAG for part in parts)
    head = struct.pack("<BII", 1, wkb.type_code(wkb.COLLECTION, has_z), len(parts))
    return head + b"".join(parts)


def gml_to_wkb(text: str | None) -> bytes | None:
    return _from_element(_element(text), None, 2) if text else None


def _element(text: str) -> ElementTree.Element:
    """The parsed element with plain tag names."""
    prefix = _OPENING.match(text)[1]
    try:
        root = ElementTree.fromstring(f'<r xmlns:{prefix[:-1]}="g">{text}</r>' if prefix else text)
    except ElementTree.ParseError:  # more prefixes, declared outside the geometry
        return ElementTree.fromstring(_PREFIX.sub(r"\1", text))
    for node in root.iter():
        node.tag = node.tag.rsplit("}", 1)[-1]
    return root[0] if prefix else root


def _from_element(element: ElementTree.Element, srs: str | None, size: int) -> bytes | None:
    srs = element.get("srsName", srs)
    size = int(element.get("srsDimension", size))
    tag = element.tag

    def read(node: ElementTree.Element) -> list:
        return _read_positions(node, srs, size)

    def rings(node: ElementTree.Element) -> list:
        return [read(ring) for ring in node.iter() if ring.tag in ("LinearRing", "Ring")]

    def members(*tags: str) -> list[ElementTree.Element]:
        return [node for node in element.iter() if node.tag in tags and node is not element]

    if tag == "Point":
        return encode("Point", (read(element) or [[]])[0])
    if tag in ("LineString", "Curve"):
        return encode("LineString", read(element))
    if tag in ("Polygon", "Surface"):
        return encode("Polygon", rings(element))
    if tag == "MultiPoint":
        return encode("MultiPoint", [read(node)[0] for node in members("Point")])
    if tag in ("MultiLineString", "MultiCurve"):
        return encode("MultiLineString", [read(node) for node in members("LineString", "Curve")])
    if tag in ("MultiPolygon", "MultiSurface"):
        return encode("MultiPolygon", [rings(node) for node in members("Polygon", "Surface")])
    if tag == "MultiGeometry":
        parts = [_from_element(child, srs, size) for node in element for child in node]
        known = [part for part in parts if part]
        return struct.pack("<BII", 1, wkb.type_code(wkb.COLLECTION, size == 3), len(known)) + b"".join(known)
    raise ValueError(f"GML geometry {tag} is not supported.")


def _read_positions(node: ElementTree.Element, srs: str | None, size: int) -> list[list[float]]:
    found: list[list[float]] = []
    for child in node.iter():
        text = (child.text or "").split()
        width = int(child.get("srsDimension", size))
        if child.tag == "pos":
            found.append([float(value) for value in text])
        elif child.tag == "posList":
            values = [float(value) for value in text]
            found += [values[at : at + width] for at in range(0, len(values), width)]
        elif child.tag == "coordinates":
            found += [[float(value) for value in pair.split(",")] for pair in text]
    code = _URN.search(srs or "")
    if code and (code[1] or code[2]) in _LATITUDE_FIRST:
        found = [[p[1], p[0], *p[2:]] for p in found]
    return found


def _position(chance: random.Random, width: int) -> list:
    return [chance.choice([chance.randint(-9, 9), chance.uniform(-1e6, 1e6), 1e-300, 5e300, 0.1]) for _ in range(width)]


def random_geojson(chance: random.Random, nested: int = 0) -> dict:
    """Any kind, of any size down to none, with positions of differing width, members in any order."""
    kind = chance.choice([*_DEPTH] + ["GeometryCollection"] * (nested < 3))
    if kind == "GeometryCollection":
        return {"type": kind, "geometries": [random_geojson(chance, nested + 1) for _ in range(chance.randint(0, 4))]}
    width = chance.choice([2, 2, 3, 4])

    def listed(depth: int) -> list:
        if depth == 0:
            return _position(chance, chance.choice([width, width, 2]))
        return [listed(depth - 1) for _ in range(chance.randint(0, 4))]

    coordinates = [] if kind == "Point" and chance.random() < 0.2 else listed(_DEPTH[kind])
    found = {"type": kind, "coordinates": coordinates}
    return dict(reversed(found.items())) if chance.random() < 0.3 else found


# GML elements, and those their members may be
GML_MEMBERS = {
    "Point": (), "LineString": (), "Curve": (), "Polygon": (), "Surface": (),
    "MultiPoint": ("Point",),
    "MultiLineString": ("LineString", "Curve"), "MultiCurve": ("LineString", "Curve"),
    "MultiPolygon": ("Polygon", "Surface"), "MultiSurface": ("Polygon", "Surface"),
}


def random_gml(chance: random.Random) -> str:
    width, prefix = chance.choice([2, 2, 3]), chance.choice(["", "gml:"])

    def element(name: str, *inner: str, more: str = "") -> str:
        return f"<{prefix}{name}{more}>{''.join(inner)}</{prefix}{name}>"

    def numbers(least: int, most: int = 4) -> str:
        found = [_position(chance, width) for _ in range(chance.randint(least, most))]
        way = chance.choice(["posList", "pos", "coordinates"])
        if way == "pos":
            return "".join(element("pos", " ".join(map(repr, one))) for one in found)
        if way == "coordinates":
            return element("coordinates", "\n", " ".join(",".join(map(repr, one)) for one in found))
        size = f' srsDimension="{width}"' if width > 2 or chance.random() < 0.5 else ""
        return element("posList", " ".join(repr(value) for one in found for value in one), more=size)

    def ring() -> str:
        if chance.random() < 0.2:
            return element("Ring", element("curveMember", element("LineString", numbers(1))))
        return element("LinearRing", numbers(1))

    def shape(kind: str, more: str = "") -> str:
        if kind == "Point":
            return element(kind, numbers(1, 1), more=more)
        if kind == "LineString":
            return element(kind, numbers(0), more=more)
        if kind == "Curve":
            return element(kind, element("segments", *(element("LineStringSegment", numbers(1)) for _ in range(2))), more=more)
        if kind == "Polygon":
            return element(kind, *(element("interior" if n else "exterior", ring()) for n in range(chance.randint(0, 3))), more=more)
        if kind == "Surface":
            return element(kind, element("patches", element("PolygonPatch", element("exterior", ring()))), more=more)
        kinds = GML_MEMBERS.get(kind, tuple(GML_MEMBERS))
        return element(kind, *(element("member", shape(chance.choice(kinds))) for _ in range(chance.randint(0, 3))), more=more)

    kind = chance.choice([*GML_MEMBERS, "MultiGeometry"])
    width = 2 if kind == "MultiGeometry" else width
    system = chance.choice(["", "urn:ogc:def:crs:EPSG::4326", "http://www.opengis.net/def/crs/EPSG/0/4258", "EPSG:4326"])
    return shape(kind, f' srsName="{system}" srsDimension="{width}"' if system else "")
