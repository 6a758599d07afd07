"""Write a DataFrame as a folder of vector files, each file by one task.

Columns ``file``, ``layer``, ``fid``, ``x`` and ``y`` (null for no geometry) place a
row, ``shape`` makes it ``line:<vertices>`` or ``polygon`` in place of a point; all other columns become attributes. The caller bounds the rows of a file
through the ``file`` column. Files appear under their final name only when complete.
"""

from __future__ import annotations

import io
import json
import os
import sqlite3
import struct
import tarfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import closing
from itertools import groupby
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from featureframe.functions.gpb import ENVELOPE_BYTES
from featureframe.functions.wkb import encode_points

PLACING = ("file", "layer", "fid", "x", "y", "shape", "srs_id", "definition")
SRS_ID = 27700
_SQLITE = {
    "bigint": "INTEGER",
    "int": "MEDIUMINT",
    "double": "DOUBLE",
    "string": "TEXT",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def gpb_point(x: float, y: float, srs_id: int = SRS_ID, code: int = 1, little: bool = True) -> bytes:
    """One GPB point with an envelope of the given code."""
    order = "<" if little else ">"
    doubles = ENVELOPE_BYTES[code] // 8
    box = [x, x, y, y, 0.0, 0.0, 0.0, 0.0][:doubles]
    head = b"GP" + struct.pack("BB", 0, code << 1 | little) + struct.pack(f"{order}i{doubles}d", srs_id, *box)
    return head + struct.pack("<BIdd", 1, 1, x, y)


def parts_of(row: dict) -> list[list[tuple[float, float]]]:
    """The vertices of a row's line, or of its polygon's outer ring (clockwise) and hole."""
    x, y, shape = row["x"], row["y"], row["shape"]
    if shape.startswith("line:"):
        return [[(x + i, y - i) for i in range(int(shape.removeprefix("line:")))]]

    def ring(low: float, size: float) -> list[tuple[float, float]]:
        left, bottom = x + low, y + low
        return [(left, bottom), (left, bottom + size), (left + size, bottom + size), (left + size, bottom), (left, bottom)]

    return [ring(0.0, 4.0), ring(1.0, 2.0)[::-1]]


def _packed(part: list[tuple[float, float]]) -> bytes:
    return struct.pack(f"<{2 * len(part)}d", *(value for vertex in part for value in vertex))


def _box(parts: list[list[tuple[float, float]]]) -> tuple[float, float, float, float]:
    xs, ys = zip(*parts[0])
    return min(xs), max(xs), min(ys), max(ys)


def gpb_shape(row: dict, srs_id: int) -> bytes:
    """One GPB line or polygon with its envelope."""
    parts = parts_of(row)
    runs = [struct.pack("<I", len(part)) + _packed(part) for part in parts]
    body = struct.pack("<BI", 1, 2) + runs[0] if len(runs) == 1 else struct.pack("<BII", 1, 3, len(runs)) + b"".join(runs)
    return b"GP" + struct.pack("<BBi4d", 0, 3, srs_id, *_box(parts)) + body


def _shape_record(row: dict) -> bytes:
    """One line or polygon as a shapefile has it."""
    parts = parts_of(row)
    min_x, max_x, min_y, max_y = _box(parts)
    firsts = np.cumsum([0, *(len(part) for part in parts[:-1])]).astype("<i4").tobytes()
    counts = struct.pack("<2i", len(parts), sum(map(len, parts)))
    head = struct.pack("<i4d", 3 if len(parts) == 1 else 5, min_x, min_y, max_x, max_y)
    return head + counts + firsts + b"".join(map(_packed, parts))


def _geojson_geometry(row: dict) -> dict | None:
    if row["x"] is None:
        return None
    if not row.get("shape"):
        return {"type": "Point", "coordinates": [row["x"], row["y"]]}
    parts = parts_of(row)
    return {"type": "LineString", "coordinates": parts[0]} if len(parts) == 1 else {"type": "Polygon", "coordinates": parts}


@F.arrow_udf(BinaryType())
def gpb_points(x: pa.Array, y: pa.Array, code: pa.Array) -> pa.Array:
    """GPB points from coordinate columns; ``code`` is the envelope code, null x gives null."""
    rows = zip(x.to_pylist(), y.to_pylist(), code.to_pylist())
    return pa.array([None if a is None else gpb_point(a, b, code=c) for a, b, c in rows], pa.binary())


@F.arrow_udf(BinaryType())
def gpb_boxed_points(x: pa.Array, y: pa.Array) -> pa.Array:
    """GPB points with the usual 40-byte header, built a batch at a time."""
    xs, ys = x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False)
    kind = [("magic", "S2"), ("version", "u1"), ("flags", "u1"), ("srs", "<i4"), ("box", "<f8", 4)]
    kind += [("order", "u1"), ("code", "<u4"), ("xy", "<f8", 2)]
    rows = np.zeros(len(xs), dtype=kind)
    rows["magic"], rows["flags"], rows["srs"], rows["order"], rows["code"] = b"GP", 3, SRS_ID, 1, 1
    rows["box"] = np.stack([xs, xs, ys, ys], axis=1)
    rows["xy"] = np.stack([xs, ys], axis=1)
    offsets = pa.py_buffer((np.arange(len(xs) + 1) * rows.dtype.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(xs), [None, offsets, pa.py_buffer(rows.tobytes())])


def write_vector_files(df: DataFrame, root: str, kind: str) -> str:
    """Write every file below ``root``; returns ``root``. Runs at once."""
    attributes = [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name not in PLACING]
    write = WRITERS[kind]
    if "://" in root:
        raise ValueError(f"Vector files are written to mounted paths only, not to {root}.")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for name, group in groupby(rows, key=lambda row: row["file"]):
            found = list(group)
            target = os.path.join(root, name)
            os.makedirs(os.path.dirname(target), exist_ok=True)
            write(target, found, attributes)
            yield pa.RecordBatch.from_pydict({"rows": [len(found)]})

    tasks = df.sparkSession.sparkContext.defaultParallelism
    placed = df.repartition(tasks, "file").sortWithinPartitions("file", "layer", "fid")
    placed.mapInArrow(run, "rows bigint").agg(F.sum("rows")).collect()
    return root


def _put(target: str, write: Callable[[str], None]) -> None:
    attempt = os.path.join(os.path.dirname(target), f".{uuid.uuid4().hex}")
    write(attempt)
    os.replace(attempt, target)


def _layers(rows: list[dict]) -> Iterator[tuple[str, list[dict]]]:
    for layer, group in groupby(rows, key=lambda row: row["layer"]):
        yield layer, list(group)


def write_geopackage(target: str, rows: list[dict], attributes: list[tuple[str, str]], indexed: bool = False) -> None:
    _put(target, lambda path: _geopackage(path, rows, attributes, indexed))


def _write_indexed_geopackage(target: str, rows: list[dict], attributes: list[tuple[str, str]]) -> None:
    write_geopackage(target, rows, attributes, indexed=True)


def _geopackage(path: str, rows: list[dict], attributes: list[tuple[str, str]], indexed: bool) -> None:
    with closing(sqlite3.connect(path)) as db:
        db.executescript(
            "create table gpkg_contents (table_name TEXT primary key, data_type TEXT, srs_id INTEGER,"
            " min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE);"
            "create table gpkg_spatial_ref_sys (srs_id INTEGER primary key, definition TEXT);"
            "create table gpkg_geometry_columns (table_name TEXT, column_name TEXT);"
            "create table gpkg_ogr_contents (table_name TEXT primary key, feature_count INTEGER);"
        )
        for layer, found in _layers(rows):
            columns = "".join(f', "{name}" {_SQLITE[kind]}' for name, kind in attributes)
            db.execute(f'create table "{layer}" (feature_id INTEGER primary key, geom POINT{columns})')
            srs_id = found[0].get("srs_id", SRS_ID)
            values = [
                (row["fid"], _gpb_blob(row, srs_id))
                + tuple(row[name] for name, _ in attributes)
                for row in found
            ]
            marks = ",".join("?" * (len(attributes) + 2))
            db.executemany(f'insert into "{layer}" values ({marks})', values)
            if indexed:
                db.execute(f'create virtual table "rtree_{layer}_geom" using rtree(id, minx, maxx, miny, maxy)')
                boxes = [(row["fid"], *(_box(parts_of(row)) if row.get("shape") else (row["x"], row["x"], row["y"], row["y"]))) for row in found if row["x"] is not None]
                db.executemany(f'insert into "rtree_{layer}_geom" values (?, ?, ?, ?, ?)', boxes)
            xs = [row["x"] for row in found if row["x"] is not None] or [None]
            ys = [row["y"] for row in found if row["x"] is not None] or [None]
            box = (min(xs), min(ys), max(xs), max(ys))
            db.execute("insert into gpkg_contents values (?, 'features', ?, ?, ?, ?, ?)", (layer, srs_id, *box))
            db.execute("insert into gpkg_geometry_columns values (?, 'geom')", (layer,))
            db.execute("insert into gpkg_ogr_contents values (?, ?)", (layer, len(found)))
            definition = found[0].get("definition", "British_National_Grid")
            db.execute("insert or ignore into gpkg_spatial_ref_sys values (?, ?)", (srs_id, definition))
        db.commit()


def _gpb_blob(row: dict, srs_id: int) -> bytes | None:
    if row["x"] is None:
        return None
    return gpb_shape(row, srs_id) if row.get("shape") else gpb_point(row["x"], row["y"], srs_id)


def shapefile_parts(rows: list[dict], attributes: list[tuple[str, str]]) -> dict[str, bytes]:
    """``.shp``, ``.shx``, ``.dbf`` and ``.cpg`` bytes of a layer."""

    def record(row: dict) -> bytes:
        if row["x"] is None:
            return struct.pack("<i", 0)
        return _shape_record(row) if row.get("shape") else struct.pack("<idd", 1, row["x"], row["y"])

    shapes = [record(row) for row in rows]
    kinds = [int.from_bytes(shape[:4], "little") for shape in shapes]
    return shape_parts(shapes, max(kinds, default=1) or 1) | {".dbf": table_part(rows, attributes), ".cpg": b"UTF-8"}


def shape_parts(shapes: list[bytes], shape_type: int) -> dict[str, bytes]:
    """``.shp`` and ``.shx`` bytes around encoded shape contents."""

    def header(size: int) -> bytes:
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i8d", 1000, shape_type, *[0.0] * 8)

    records, index, at = b"", b"", 100
    pieces, entries = [], []
    for number, shape in enumerate(shapes, 1):
        pieces.append(struct.pack(">2i", number, len(shape) // 2) + shape)
        entries.append(struct.pack(">2i", at // 2, len(shape) // 2))
        at += 8 + len(shape)
    records, index = b"".join(pieces), b"".join(entries)
    return {".shp": header(100 + len(records)) + records, ".shx": header(100 + len(index)) + index}


_DBF = {
    "bigint": (b"N", 18, 0),
    "int": (b"N", 9, 0),
    "double": (b"N", 24, 15),
    "string": (b"C", 80, 0),
    "date": (b"D", 8, 0),
}


def table_part(rows: list[dict], attributes: list[tuple[str, str]], deleted: set[int] = frozenset()) -> bytes:
    """``.dbf`` bytes; rows at the ordinals in ``deleted`` are flagged as deleted."""
    kinds = [_DBF[kind] for _, kind in attributes]
    width = 1 + sum(size for _, size, _ in kinds)
    head = struct.pack("<4BIHH20x", 3, 120, 1, 1, len(rows), 33 + 32 * len(attributes), width)
    for (name, _), (code, size, decimals) in zip(attributes, kinds):
        if len(name.encode()) > 10:
            raise ValueError(f"{name} is longer than the 10 bytes a field name has.")
        head += struct.pack("<11sc4xBB14x", name.encode(), code, size, decimals)
    lines = []
    for ordinal, row in enumerate(rows):
        cells = [b"*" if ordinal in deleted else b" "]
        for (name, _), (code, size, decimals) in zip(attributes, kinds):
            cells.append(_cell(row[name], code, size))
        lines.append(b"".join(cells))
    return head + b"\r" + b"".join(lines) + b"\x1a"


def _cell(value: object, code: bytes, size: int) -> bytes:
    if value is None:
        return b" " * size
    if code == b"N":
        return repr(value).encode().rjust(size)
    if code == b"D":
        return value.strftime("%Y%m%d").encode()
    text = str(value).encode("utf-8")
    if len(text) > size:
        raise ValueError(f"{value!r} is longer than the {size} bytes of its field.")
    return text.ljust(size)


def write_shapefile(target: str, rows: list[dict], attributes: list[tuple[str, str]]) -> None:
    """One shapefile; for a target ending in ``.gdb`` a folder with one per layer."""
    if target.endswith(".gdb"):
        os.makedirs(target, exist_ok=True)
        bases = [(os.path.join(target, layer), found) for layer, found in _layers(rows)]
    else:
        bases = [(os.path.splitext(target)[0], rows)]
    for base, found in bases:
        parts = shapefile_parts(found, attributes)
        for extension in (".dbf", ".cpg", ".shx", ".shp"):
            _put(base + extension, lambda path: _dump(path, parts[extension]))


def _dump(path: str, data: bytes) -> None:
    with open(path, "wb") as file:
        file.write(data)


def write_archive(target: str, rows: list[dict], attributes: list[tuple[str, str]]) -> None:
    """A ``.tar.gz`` of the parts of one shapefile."""
    base = os.path.basename(target).split(".")[0]

    def write(path: str) -> None:
        with tarfile.open(path, "w:gz") as archive:
            for extension, data in shapefile_parts(rows, attributes).items():
                member = tarfile.TarInfo(base + extension)
                member.size = len(data)
                archive.addfile(member, io.BytesIO(data))

    _put(target, write)


def write_zip(target: str, rows: list[dict], attributes: list[tuple[str, str]]) -> None:
    """A ``.zip`` with the parts of one shapefile per layer."""

    def write(path: str) -> None:
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for layer, found in _layers(rows):
                for extension, data in shapefile_parts(found, attributes).items():
                    archive.writestr(f"{layer}/{layer}{extension}", data)

    _put(target, write)


def _geojson_features(rows: list[dict], attributes: list[tuple[str, str]], **leading: object) -> list[dict]:
    return [
        {
            "type": "Feature",
            "properties": {**leading, **{name: row[name] for name, _ in attributes}},
            "geometry": _geojson_geometry(row),
        }
        for row in rows
    ]


def write_geojson(target: str, rows: list[dict], attributes: list[tuple[str, str]], **leading: object) -> None:
    features = map(json.dumps, _geojson_features(rows, attributes, **leading))
    text = '{"type": "FeatureCollection", "name": ' + json.dumps(rows[0]["layer"]) + ', "features": [\n'
    _put(target, lambda path: _dump(path, (text + ",\n".join(features) + "\n]}\n").encode()))


def write_geojson_nested(target: str, rows: list[dict], attributes: list[tuple[str, str]]) -> None:
    """Features whose first property reads like the beginning of a feature."""
    write_geojson(target, rows, attributes, type="Feature")


def write_geojson_lines(target: str, rows: list[dict], attributes: list[tuple[str, str]]) -> None:
    """One feature per line, the first one longer than 1 MiB before its type comes."""
    first, *rest = _geojson_features(rows, attributes)
    lines = map(json.dumps, [{"id": "x" * (5 << 18), **first}, *rest])
    _put(target, lambda path: _dump(path, ("\n".join(lines) + "\n").encode()))


def write_geojson_sequence(target: str, rows: list[dict], attributes: list[tuple[str, str]]) -> None:
    """Features that each begin with a record separator and may go over several lines."""
    features = _geojson_features(rows, attributes)
    _put(target, lambda path: _dump(path, "".join(f"\x1e{json.dumps(one, indent=1)}\n" for one in features).encode()))


def _gml_geometry(row: dict) -> str:
    if not row.get("shape"):
        return f"<gml:Point><gml:coordinates>{row['x']!r},{row['y']!r}</gml:coordinates></gml:Point>"
    lists = [f"<gml:posList>{' '.join(repr(value) for vertex in part for value in vertex)}</gml:posList>" for part in parts_of(row)]
    if len(lists) == 1:
        return f"<gml:LineString>{lists[0]}</gml:LineString>"
    rings = [f"<gml:LinearRing>{one}</gml:LinearRing>" for one in lists]
    inner = "".join(f"<gml:interior>{one}</gml:interior>" for one in rings[1:])
    return f"<gml:Polygon><gml:exterior>{rings[0]}</gml:exterior>{inner}</gml:Polygon>"


def write_gml(target: str, rows: list[dict], attributes: list[tuple[str, str]]) -> None:
    namespaces = 'xmlns:ogr="http://ogr.maptools.org/" xmlns:gml="http://www.opengis.net/gml"'
    late = f"<!-- {'x' * (5 << 18)} -->"  # the first feature comes after 1 MiB
    lines = ['<?xml version="1.0" encoding="utf-8" ?>', f"<ogr:FeatureCollection {namespaces}>", late]
    for row in rows:
        layer = row["layer"]
        values = "".join(f"<ogr:{n}>{escape(str(row[n]))}</ogr:{n}>" for n, _ in attributes if row[n] is not None)
        shape = ""
        if row["x"] is not None:
            shape = _gml_geometry(row)
            shape = f"<ogr:geometryProperty>{shape}</ogr:geometryProperty>"
        body = f'<ogr:{layer} fid="{layer}.{row["fid"]}">{shape}{values}</ogr:{layer}>'
        lines.append(f"<gml:featureMember>{body}</gml:featureMember>")
    lines.append("</ogr:FeatureCollection>")
    _put(target, lambda path: _dump(path, "\n".join(lines).encode()))


WRITERS = {
    "geopackage": write_geopackage,
    "geopackage-indexed": _write_indexed_geopackage,
    "shapefile": write_shapefile,
    "archive": write_archive,
    "zip": write_zip,
    "geojson": write_geojson,
    "geojson-lines": write_geojson_lines,
    "geojson-nested": write_geojson_nested,
    "geojson-sequence": write_geojson_sequence,
    "gml": write_gml,
}
