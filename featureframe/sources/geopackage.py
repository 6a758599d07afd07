"""GeoPackage (and plain SQLite) tables, read by rowid range.

SQLite needs a file on a path the executor can open, so GeoPackages must lie on
storage that is mounted on every executor.
"""

from __future__ import annotations

import os
import re
import sqlite3
import struct
from collections.abc import Iterator
from contextlib import closing
from itertools import compress
from urllib.parse import quote

import numpy as np
import pyarrow as pa

from featureframe.functions.boxes import Box
from featureframe.functions.buffers import binary_layout, doubles_at
from featureframe.functions.gpb import ENVELOPE_BYTES, FIXED_BYTES
from featureframe.functions.wkb import LINESTRING, POINT, POLYGON, corners, little_endian
from featureframe.sources.layers import (
    BATCH_BYTES,
    BATCH_ROWS,
    Attribute,
    Layer,
    NotVectorData,
    RowBatches,
    Rows,
    absent,
)
from featureframe.types import base_declared_type, sqlite_ogr_type

# A layer whose id range is wider than this many times its rows is sparse: equal
# id ranges would leave some tasks full and most empty.
SPARSE_FACTOR = 4
_FIRST_ROWS = 64
# header bytes by the flag bits that hold the envelope code
_HEADER_BYTES = {code << 1: FIXED_BYTES + size for code, size in enumerate(ENVELOPE_BYTES)}
# heads of little-endian 2D geometries without parts of their own byte order
_PLAIN = {struct.pack("<BI", 1, code) for code in (POINT, LINESTRING, POLYGON)}


# SQLite result codes
_DAMAGED = {11, 26}  # malformed, not a database
_NO_SIDE_FILES = {8, 14}  # read-only storage, where a write-ahead log cannot be set up
_LOCK_SECONDS = 5.0


def is_damaged(error: Exception) -> bool:
    """Whether SQLite says that the file itself is no sound database."""
    return isinstance(error, sqlite3.Error) and getattr(error, "sqlite_errorcode", 0) & 0xFF in _DAMAGED


def connect(path: str) -> sqlite3.Connection:
    """The database at a mounted path. A lock is waited for, then an error, and never read past."""
    if "://" in path:
        raise OSError(f"SQLite cannot open {path}; use a mounted path.")
    if not os.path.isfile(path):
        raise NotVectorData(f"{path} is a folder.") if os.path.isdir(path) else absent(path)
    uri = f"file:{quote(path)}?mode=ro"
    try:
        return _opened(uri)
    except sqlite3.OperationalError as error:
        if error.sqlite_errorcode & 0xFF not in _NO_SIDE_FILES or _has_log(path):
            raise
        # nobody writes to read-only storage either
        return _opened(f"{uri}&immutable=1")


def _opened(uri: str) -> sqlite3.Connection:
    db = sqlite3.connect(uri, uri=True, timeout=_LOCK_SECONDS)
    try:
        db.execute("select 1 from sqlite_master limit 1").fetchall()
    except sqlite3.Error:
        db.close()
        raise
    return db


def _has_log(path: str) -> bool:
    """Whether changes wait beside the file that it does not have yet."""
    logs = (path + ending for ending in ("-wal", "-journal"))
    return any(os.path.isfile(log) and os.path.getsize(log) for log in logs)


def identifier(name: str) -> str:
    """A quoted SQL identifier."""
    return '"' + name.replace('"', '""') + '"'


def answers(path: str, query: str, tables: tuple[str, ...]) -> list[tuple]:
    """Rows of a query on metadata tables; none where the file lacks one of them."""
    with closing(connect(path)) as db:
        return db.execute(query).fetchall() if _tables(db).issuperset(tables) else []


def _tables(db: sqlite3.Connection) -> set[str]:
    return {name for (name,) in db.execute("select name from sqlite_master where type in ('table', 'view')")}


def declared_columns(db: sqlite3.Connection, table: str) -> list[tuple[str, str, bool]]:
    """``(name, declared type, is primary key)`` of a table, in order."""
    return [(row[1], row[2] or "", bool(row[5])) for row in db.execute(f"pragma table_info({identifier(table)})")]


def id_bounds(db: sqlite3.Connection, table: str) -> tuple[int | None, int | None]:
    """Smallest and largest rowid; None for views and tables without rowids."""
    try:
        low, high = (
            db.execute(f"select {end}(rowid) from {identifier(table)}").fetchone()[0] for end in ("min", "max")
        )
    except sqlite3.OperationalError:
        return None, None
    return (low, high) if isinstance(low, int) and isinstance(high, int) else (None, None)


def range_starts(path: str, table: str, rows: int) -> list[int]:
    """Rowids that begin ranges of exactly ``rows`` rows, by one pass over the ids."""
    with closing(connect(path)) as db:
        starts, (at, _) = [], id_bounds(db, table)
        step = f"select rowid from {identifier(table)} where rowid >= ? order by rowid limit 1 offset ?"
        while at is not None:
            starts.append(at)
            found = db.execute(step, (at, rows)).fetchone()
            at = found[0] if found else None
        return starts


def is_sparse(feature_count: int, first_id: int | None, last_id: int | None) -> bool:
    return first_id is not None and last_id - first_id + 1 > SPARSE_FACTOR * max(feature_count, 1)


def _geometry_column(db: sqlite3.Connection, layer: str) -> str | None:
    if "gpkg_geometry_columns" not in _tables(db):
        return None
    query = "select column_name from gpkg_geometry_columns where table_name = ?"
    found = db.execute(query, (layer,)).fetchone()
    return found[0] if found else None


def _feature_count(db: sqlite3.Connection, table: str, tables: set[str]) -> int:
    """The count the file keeps for the layer, or a counted one."""
    if "gpkg_ogr_contents" in tables:
        query = "select feature_count from gpkg_ogr_contents where lower(table_name) = lower(?)"
        found = db.execute(query, (table,)).fetchone()
        if found and found[0] is not None:
            return found[0]
    return row_count(db, table)


def row_count(db: sqlite3.Connection, table: str) -> int:
    return db.execute(f"select count(*) from {identifier(table)}").fetchone()[0]


def layer_names(path: str) -> list[str]:
    """Layers in the order of the contents table, or all tables of a plain SQLite file."""
    with closing(connect(path)) as db:
        tables = _tables(db)
        if "gpkg_contents" not in tables:
            return sorted(name for name in tables if not name.startswith("sqlite_"))
        kinds = "('features', 'attributes', 'aspatial')"
        rows = db.execute(f"select table_name from gpkg_contents where data_type in {kinds} order by rowid")
        return [name for (name,) in rows]


def attributes(path: str, layer: str) -> list[Attribute]:
    """Attributes of a layer: every column but the feature id and the geometry."""
    with closing(connect(path)) as db:
        return _attributes(db, layer, _geometry_column(db, layer))


def _attributes(db: sqlite3.Connection, layer: str, geometry: str | None) -> list[Attribute]:
    columns = declared_columns(db, layer)
    hidden = {geometry, _row_id_column(columns)}
    return [Attribute(name, *sqlite_ogr_type(declared)) for name, declared, _ in columns if name not in hidden]


def describe(path: str, layer: str) -> Layer:
    with closing(connect(path)) as db:
        found = _attributes(db, layer, _geometry_column(db, layer))
        return Layer(layer, _feature_count(db, layer, _tables(db)), found, *id_bounds(db, layer))


def _row_id_column(columns: list[tuple[str, str, bool]]) -> str | None:
    """The integer primary key, which a vector layer shows as feature id, not as attribute."""
    keys = [(name, declared) for name, declared, key in columns if key]
    return keys[0][0] if len(keys) == 1 and base_declared_type(keys[0][1]) == "INTEGER" else None


def fetch(
    path: str, table: str, columns: list[str], start: int | None, stop: int | None
) -> Iterator[tuple[int, list[list]]]:
    """``(rows, values per column)`` for rowids in ``[start, stop)``; text comes as bytes.

    Columns the file's table lacks are null; a file without the table has no rows.
    """
    with closing(connect(path)) as db:
        # SQLite takes a quoted name it does not know for text
        known = {name.lower() for name, _, _ in declared_columns(db, table)}
        if not known:
            return
        present = [name for name in columns if name.lower() in known]
        for count, values in _fetch(db, table, present, start, stop):
            found = dict(zip(present, values))
            yield count, [found.get(name, [None] * count) for name in columns]


def _fetch(
    db: sqlite3.Connection,
    table: str,
    columns: list[str],
    start: int | None,
    stop: int | None,
    index: str | None = None,
    box: Box | None = None,
) -> Iterator[tuple[int, list[list]]]:
    """Rows of rowids in ``[start, stop)``; with an R-tree ``index`` only those it has near the box."""
    conditions = [("rowid >= ?", [start]), ("rowid < ?", [stop])]
    conditions = [(text, values) for text, values in conditions if values != [None]]
    if index is not None:
        near = "select id from {} where minx <= ? and maxx >= ? and miny <= ? and maxy >= ?".format(identifier(index))
        conditions.append((f"rowid in ({near})", [box.max_x, box.min_x, box.max_y, box.min_y]))
    where = " and ".join(text for text, _ in conditions)
    chosen = ", ".join(identifier(name) for name in columns) or "1"
    query = f"select {chosen} from {identifier(table)}" + (f" where {where}" if where else "")
    db.text_factory = bytes  # Arrow decodes whole columns
    cursor = db.execute(query, [value for _, values in conditions for value in values])
    size = _FIRST_ROWS
    while rows := cursor.fetchmany(size):
        values = [list(column) for column in zip(*rows)]
        yield len(rows), values[: len(columns)]
        size = _next_size(size, values)


def _spatial_index(db: sqlite3.Connection, layer: str, geometry: str) -> str | None:
    """The R-tree over a geometry column, if there is one that this SQLite can read."""
    name = f"rtree_{layer}_{geometry}"
    if name not in _tables(db):
        return None
    try:
        db.execute(f"select id from {identifier(name)} limit 1").fetchall()
    except sqlite3.OperationalError:  # SQLite without the module
        return None
    return name


def _next_size(size: int, values: list[list]) -> int:
    """Rows to fetch next, so that geometries as large as the last ones fit a batch."""
    stride = max(len(values[0]) // 256, 1)
    held = stride * sum(len(value) for column in values for value in column[::stride] if type(value) is bytes)
    fitting = BATCH_BYTES * size // max(held, 1)
    return max(1, min(BATCH_ROWS, size * 8, fitting))


def batches(
    path: str, layer: str, start: int | None, stop: int | None, columns: list[str] | None, box: Box | None = None
) -> RowBatches:
    """Rows of a layer with plain WKB geometry; ``columns`` limits what is read.

    With a ``box`` only rows whose geometry's bounds meet it: those the layer's R-tree has
    near, told apart by the envelopes in their headers before anything is decoded.
    """
    with closing(connect(path)) as db:
        geometry = _geometry_column(db, layer)
        if box is not None and geometry is None:
            return
        index = None if box is None else _spatial_index(db, layer, geometry)
        wanted = [a for a in _attributes(db, layer, geometry) if columns is None or a.name in columns]
        names = [a.name for a in wanted] + ([geometry] if geometry else [])
        for count, values in _fetch(db, layer, names, start, stop, index, box):
            if box is not None:
                near = box.meets(_corners(values[-1]))
                count, values = int(near.sum()), [list(compress(column, near)) for column in values]
                if not count:
                    continue
            shapes = pa.array([_wkb(blob) for blob in values[-1]], pa.binary()) if geometry else None
            arrays = {a.name: _array(a, column) for a, column in zip(wanted, values)}
            yield Rows(count, arrays, shapes)


def _corners(blobs: list[bytes | None]) -> np.ndarray:
    """``minx, maxx, miny, maxy`` of each geometry, from the header where that has them."""
    data, starts, lengths, valid = binary_layout(pa.array(blobs, pa.binary()))
    valid = valid & (lengths >= FIXED_BYTES)
    flags = np.zeros(len(starts), np.uint8)
    flags[valid] = data[starts[valid] + 3]
    sizes = np.array([_HEADER_BYTES.get(code << 1, -1) for code in range(8)])[flags >> 1 & 7]
    valid &= (sizes > 0) & (lengths >= sizes)
    found = corners(data, starts + sizes, lengths - sizes, valid & (sizes == FIXED_BYTES))
    for bit, dtype in ((1, "<f8"), (0, ">f8")):
        boxed = np.flatnonzero(valid & (sizes > FIXED_BYTES) & (flags & 1 == bit))
        found[boxed] = doubles_at(data, starts[boxed] + FIXED_BYTES, 4, dtype)
    return found


def _wkb(blob: bytes | None) -> bytes | None:
    """The WKB behind a GPB header; a geometry flagged as empty is still a geometry."""
    if blob is None:
        return None
    header = _HEADER_BYTES.get(blob[3] & 14) if len(blob) > 3 else None
    if header is None:  # an envelope code the format does not have: no way to tell where the shape begins
        return None
    shape = blob[header:]
    return shape if shape[:5] in _PLAIN else little_endian(shape)


def _array(attribute: Attribute, values: list) -> list:
    kind = (attribute.ogr_type, attribute.ogr_subtype)
    if kind not in ((9, 0), (11, 0)):
        return values
    texts = [value.decode("utf-8", "replace") if isinstance(value, bytes) else value for value in values]
    show = _date if kind == (9, 0) else _date_time
    return [show(text) if isinstance(text, str) else text for text in texts]


def _date(text: str) -> str:
    return text.replace("-", "/")


# Parts of an ISO date-time, and how a vector reader prints them
_ISO = re.compile(r"(\d{4})-(\d{2})-(\d{2})[T ](\d{2}):(\d{2})(?::(\d{2})(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$")


def _date_time(text: str) -> str:
    """``2020-01-31T12:34:56.000Z`` -> ``2020/01/31 12:34:56+00``."""
    found = _ISO.match(text)
    if not found:
        return text
    year, month, day, hour, minute, second, fraction, zone = found.groups()
    millis = round(float(fraction or 0) * 1000)
    tail = f".{millis:03d}" if 0 < millis < 1000 else ""
    offset = "" if zone is None else "+00" if zone == "Z" else zone.replace(":", "").removesuffix("00")
    return f"{year}/{month}/{day} {hour}:{minute}:{second or '00'}{tail}{offset or ''}"
