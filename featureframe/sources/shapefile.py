"""Shapefiles, and folders of shapefiles as one source with several layers.

Rows are addressed by record ordinal: ``.shx`` gives the byte range of every
shape and ``.dbf`` records have one width, so any ordinal range is two seeks away.
"""

from __future__ import annotations

import codecs
import os
import struct
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from typing import BinaryIO, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from featureframe.functions import wkb
from featureframe.functions.assemble import Parts, assemble, offsets_of
from featureframe.functions.boxes import Box
from featureframe.functions.buffers import doubles_at, gather
from featureframe.sources.layers import (
    BATCH_BYTES,
    BATCH_ROWS,
    Attribute,
    Layer,
    NotVectorData,
    RowBatches,
    Rows,
    absent,
    existing,
    list_folder,
    open_binary,
)

# The shapefile format
SHP_HEADER = 100
SHX_RECORD = 8
POINT_TYPES = (1, 11, 21)
LINE_TYPES = (3, 13, 23)
POLYGON_TYPES = (5, 15, 25)
MULTIPOINT_TYPES = (8, 18, 28)
NO_DATA = -1e38
# Fixed values: .dbf language driver ids -> codec
LANGUAGE_CODECS = {
    1: "cp437",
    2: "cp850",
    3: "cp1252",
    87: "cp1252",
    100: "cp852",
    101: "cp866",
    200: "cp1250",
    201: "cp1251",
}


def layer_names(path: str) -> list[str]:
    """The layer of a ``.shp``/``.dbf`` file, or all layers of a folder by name."""
    return [_stem(member) for member in _members(path)]


def attributes(path: str, layer: str) -> list[Attribute]:
    with _open(path, layer) as (table, _):
        return table.attributes


def describe(path: str, layer: str) -> Layer:
    with _open(path, layer) as (table, shapes):
        count = _record_count(table, shapes)
        return Layer(layer, count, table.attributes, 0, count - 1)


def batches(
    path: str, layer: str, start: int | None, stop: int | None, columns: list[str] | None, box: Box | None = None
) -> RowBatches:
    """Rows with ordinals in ``[start, stop)``; ``columns`` limits what is decoded.

    With a ``box`` only rows whose geometry's bounds meet it, told by the bounds each
    record begins with; nothing of other records is decoded.
    """
    with _open(path, layer) as (table, shapes):
        if box is not None and (shapes is None or not shapes.may_meet(box)):
            return
        total = _record_count(table, shapes)
        start, stop = max(start or 0, 0), total if stop is None else min(stop, total)
        for low, high in _cuts(shapes, start, stop):
            near = None
            if box is not None:
                near, geometry = shapes.read_near(low, high, box)
                if not near.any():
                    continue
            else:
                geometry = shapes.read(low, high) if shapes else pa.nulls(high - low, pa.binary())
            arrays, kept = table.read(low, high, columns, near)
            if not kept.all():  # records flagged as deleted
                mask = pa.array(kept)
                arrays = {name: array.filter(mask) for name, array in arrays.items()}
                geometry = geometry.filter(mask)
            yield Rows(int(kept.sum()), arrays, geometry)


def _cuts(shapes: _Shapes | None, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """Cut ``[start, stop)`` into batches bounded in rows and in geometry bytes."""
    for low in range(start, stop, BATCH_ROWS):
        high = min(low + BATCH_ROWS, stop)
        sizes = shapes.entries(low, high)[:, 1] if shapes else np.empty(0, np.int64)
        groups = np.cumsum(sizes) // BATCH_BYTES
        inner = low + 1 + np.flatnonzero(np.diff(groups))
        bounds = [low, *inner.tolist(), high]
        yield from zip(bounds, bounds[1:])


def _stem(member: str) -> str:
    return os.path.splitext(os.path.basename(member))[0]


def _members(path: str) -> list[str]:
    """``.shp`` files of a source, and ``.dbf`` files that have no ``.shp``."""
    if path.lower().endswith((".shp", ".dbf")):
        if existing([path]) is None:
            raise absent(path)
        # a .dbf beside a .shp is no source of its own
        return [] if path.lower().endswith(".dbf") and _sibling(path, ".shp") else [path]
    try:
        files = [file for file, _ in list_folder(path)]
    except FileNotFoundError:
        raise absent(path) from None
    except NotADirectoryError:
        raise NotVectorData(f"{path} is no folder of shapefiles.") from None
    shapes = [f for f in files if f.lower().endswith(".shp")]
    stems = {_stem(f) for f in shapes}
    tables = [f for f in files if f.lower().endswith(".dbf") and _stem(f) not in stems]
    return sorted(shapes + tables, key=_stem)


def _sibling(member: str, extension: str) -> str | None:
    base = os.path.splitext(member)[0]
    return existing([base + extension, base + extension.upper()])


def _record_count(table: _Table, shapes: _Shapes | None) -> int:
    return max(table.count, shapes.count if shapes else 0)


@contextmanager
def _open(path: str, layer: str) -> Iterator[tuple[_Table, _Shapes | None]]:
    """Table and shapes of a layer; each of its files is opened once."""
    member = next(m for m in _members(path) if _stem(m) == layer)
    with ExitStack() as files:
        table = _Table(_sibling(member, ".dbf"), _sibling(member, ".cpg"), files)
        yield table, _Shapes(member, files) if member.lower().endswith(".shp") else None


class _Table:
    """Attribute records of a ``.dbf`` file; a missing file has no attributes."""

    def __init__(self, path: str | None, code_page: str | None, files: ExitStack) -> None:
        self.path, self.count, self.attributes, self.encoding = path, 0, [], "latin-1"
        if path is None:
            return
        self.file = files.enter_context(open_binary(path))
        header = self.file.read(32)
        if len(header) < 32:
            raise NotVectorData(f"{path} ends in its header.")
        self.count, self.header_bytes, self.record_bytes = struct.unpack_from("<IHH", header, 4)
        descriptors = self.file.read(max(self.header_bytes - 32, 0))
        if len(descriptors) < self.header_bytes - 32 or self.header_bytes < 33:
            raise NotVectorData(f"{path} ends in its header.")
        self.encoding = _encoding(code_page, header[29])
        names, formats, offsets, position = ["_deleted"], ["S1"], [0], 1
        self.kinds: dict[str, str] = {}
        for at in range(0, len(descriptors) - 31, 32):
            entry = descriptors[at : at + 32]
            if entry[0] == 0x0D:
                break
            name = entry[:11].split(b"\0")[0].decode(self.encoding)
            width = entry[16]
            attribute = Attribute(name, *_field_type(chr(entry[11]), width, entry[17]))
            self.attributes.append(attribute)
            self.kinds[name] = chr(entry[11])
            names.append(name)
            formats.append(f"S{width}")
            offsets.append(position)
            position += width
        self.dtype = np.dtype({"names": names, "formats": formats, "offsets": offsets, "itemsize": self.record_bytes})

    def read(
        self, low: int, high: int, columns: list[str] | None, chosen: np.ndarray | None = None
    ) -> tuple[dict[str, pa.Array], np.ndarray]:
        """Attribute arrays of records ``[low, high)``, or of the ``chosen`` of them, and which are not deleted."""
        wanted = [a for a in self.attributes if columns is None or a.name in columns]
        rows = high - low if chosen is None else int(chosen.sum())
        if self.path is None or low >= self.count:
            return {a.name: pa.nulls(rows) for a in wanted}, np.ones(rows, dtype=bool)
        self.file.seek(self.header_bytes + low * self.record_bytes)
        data = self.file.read((min(high, self.count) - low) * self.record_bytes)
        if len(data) < (min(high, self.count) - low) * self.record_bytes:
            raise ValueError(f"{self.path} ends before record {high}.")
        records = np.frombuffer(data, self.dtype)
        if chosen is not None:
            records = records[chosen[: len(records)]]
        missing = rows - len(records)
        arrays = {}
        for attribute in wanted:
            array = self._array(records[attribute.name], attribute)
            arrays[attribute.name] = pa.concat_arrays([array, pa.nulls(missing, array.type)]) if missing else array
        kept = np.concatenate([records["_deleted"] != b"*", np.ones(missing, dtype=bool)])
        return arrays, kept

    def _array(self, cells: np.ndarray, attribute: Attribute) -> pa.Array:
        trimmed = np.char.strip(cells, b" \0")
        kind = self.kinds[attribute.name]
        if kind in "NF":
            null = (trimmed == b"") | np.char.startswith(trimmed, b"*")
            return _numbers(np.where(null, b"0", trimmed), null, np.float64 if attribute.ogr_type == 2 else np.int64)
        text = self._text(trimmed)
        if kind == "D":
            dashes = pc.replace_substring_regex(text, r"^(\d{4})(\d{2})(\d{2})$", r"\1/\2/\3")
            return pc.if_else(pc.is_in(text, pa.array(["", "0", "00000000"])), None, dashes)
        empty = pa.array(["", "?"] if kind == "L" else [""])
        return pc.if_else(pc.is_in(text, empty), None, text)

    def _text(self, cells: np.ndarray) -> pa.Array:
        raw = pa.array(cells.tolist(), pa.binary())
        try:
            if self.encoding == "utf-8" or not (cells.view(np.uint8) & 0x80).any():
                return raw.cast(pa.string())
        except pa.ArrowInvalid:
            pass
        return pa.array([cell.decode(self.encoding, "replace") for cell in cells.tolist()], pa.string())


def _numbers(cells: np.ndarray, null: np.ndarray, dtype: type) -> pa.Array:
    try:
        return pa.array(cells.astype(dtype), mask=null)
    except ValueError:  # some cell is no plain number of this type
        values = [None if skip else _number(cell, dtype) for cell, skip in zip(cells.tolist(), null)]
        return pa.array(values, pa.from_numpy_dtype(dtype))


def _number(cell: bytes, dtype: type) -> float | int | None:
    try:
        return dtype(float(cell)).item()
    except (ValueError, OverflowError):
        return None


def _encoding(code_page: str | None, language_id: int) -> str:
    if code_page is None:
        return LANGUAGE_CODECS.get(language_id, "latin-1")
    with open_binary(code_page) as file:
        name = file.read(64).decode("ascii", "replace").strip()
    try:
        return codecs.lookup(f"cp{name}" if name.isdigit() else name).name
    except LookupError:
        return "latin-1"


def _field_type(kind: str, width: int, decimals: int) -> tuple[int, int]:
    if kind == "D":
        return (9, 0)
    if kind not in "NF":
        return (4, 0)
    if decimals or width > 18:
        return (2, 0)
    return (0, 0) if width < 10 else (12, 0)


class _Shapes:
    """Geometries of a ``.shp`` file, found through its ``.shx`` index."""

    def __init__(self, path: str, files: ExitStack) -> None:
        self.path = path
        index = _sibling(path, ".shx")
        if index is None:
            raise NotVectorData(f"{path} has no .shx index.")
        self._files, self._shapes = files, None
        self.index = files.enter_context(open_binary(index))
        header = self.index.read(28)
        if len(header) < 28 or header[:4] != b"\0\0\x27\x0a":
            raise NotVectorData(f"{index} is not a shapefile index.")
        (words,) = struct.unpack_from(">i", header, 24)
        self.count = (words * 2 - SHP_HEADER) // SHX_RECORD

    def entries(self, low: int, high: int) -> np.ndarray:
        """``(offset, length)`` in bytes of the records of ``[low, high)`` the index has."""
        known = max(min(high, self.count) - low, 0)
        self.index.seek(SHP_HEADER + low * SHX_RECORD)
        words = np.frombuffer(self.index.read(known * SHX_RECORD), ">i4")
        return words.reshape(-1, 2).astype(np.int64) * 2

    def _records(self, low: int, high: int) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Bytes that hold the records of ``[low, high)`` the index has, and where in them each begins and its size."""
        entries = self.entries(low, high)
        begin, sizes = entries[:, 0] + 8, entries[:, 1]
        if not len(entries):
            return b"", begin, sizes
        if self._shapes is None:
            self._shapes = self._files.enter_context(open_binary(self.path))
        data, starts = _read_records(self._shapes, begin, sizes)
        if len(data) < int((starts + sizes).max()):
            raise ValueError(f"{self.path} ends before record {low + len(entries)}.")
        return data, starts, sizes

    def read(self, low: int, high: int) -> pa.Array:
        data, starts, sizes = self._records(low, high)
        missing = pa.nulls(high - low - len(starts), pa.binary())
        if not len(starts):
            return missing
        geometry = _to_wkb(data, starts, sizes)
        return pa.concat_arrays([geometry, missing]) if len(missing) else geometry

    def may_meet(self, box: Box) -> bool:
        """Whether the bounds in the file's header meet the box; bounds without an extent say nothing."""
        if self._shapes is None:
            self._shapes = self._files.enter_context(open_binary(self.path))
        self._shapes.seek(36)
        head = self._shapes.read(32)
        if len(head) < 32:
            raise NotVectorData(f"{self.path} ends in its header.")
        min_x, min_y, max_x, max_y = struct.unpack("<4d", head)
        known = min_x < max_x or min_y < max_y
        return not known or bool(box.meets(np.array([[min_x, max_x, min_y, max_y]]))[0])

    def read_near(self, low: int, high: int, box: Box) -> tuple[np.ndarray, pa.Array]:
        """Which records of ``[low, high)`` meet the box, and the geometry of these alone."""
        data, starts, sizes = self._records(low, high)
        near = np.zeros(high - low, bool)
        if not len(starts):
            return near, pa.nulls(0, pa.binary())
        view, found = np.frombuffer(data, np.uint8), np.full((len(starts), 4), np.nan)
        codes = gather(view, starts, 4).view("<i4").ravel()
        points = np.isin(codes, POINT_TYPES)
        found[points] = np.repeat(doubles_at(view, starts[points] + 4, 2, "<f8"), 2, axis=1)
        others = ~points & (codes != 0)
        found[others] = doubles_at(view, starts[others] + 4, 4, "<f8")[:, [0, 2, 1, 3]]
        near[: len(starts)] = meeting = box.meets(found)
        if not meeting.any():
            return near, pa.nulls(0, pa.binary())
        return near, _to_wkb(data, starts[meeting], sizes[meeting])


def _read_records(file: BinaryIO, begin: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bytes holding the records and where in them each record starts."""
    first, last = int(begin.min()), int((begin + sizes).max())
    if last - first <= 2 * int(sizes.sum()) + BATCH_BYTES:
        file.seek(first)
        return file.read(last - first), begin - first
    pieces = []  # records of an edited file may lie far apart
    for at, size in zip(begin.tolist(), sizes.tolist()):
        file.seek(at)
        pieces.append(file.read(size))
    lengths = [len(piece) for piece in pieces]
    return b"".join(pieces), np.cumsum([0, *lengths[:-1]])


def _to_wkb(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    view = np.frombuffer(data, np.uint8)
    codes = gather(view, starts, 4).view("<i4").ravel()
    if np.isin(codes, (0, 1)).all():  # 2D points only: one vectorised gather
        valid = codes == 1
        xy = np.zeros((len(codes), 2))
        xy[valid] = doubles_at(view, starts[valid] + 4, 2, "<f8")
        return wkb.encode_points(xy[:, 0], xy[:, 1], valid)
    plain = np.isin(codes, (3, 5))  # 2D lines and polygons, all at once
    found, together = _parted(view, starts, codes, np.flatnonzero(plain))
    alone = np.ones(len(codes), bool)
    alone[together] = False
    records = zip(*(one[alone].tolist() for one in (starts, lengths, codes)))
    others = pa.array([_shape_wkb(data, at, at + size, code) for at, size, code in records], pa.binary())
    order = np.empty(len(codes), np.int64)
    order[together], order[alone] = np.arange(len(together)), len(together) + np.arange(len(others))
    return pa.concat_arrays([found, others]).take(pa.array(order))


def _parted(view: np.ndarray, starts: np.ndarray, codes: np.ndarray, records: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """WKB of the 2D lines among ``records`` and of their polygons with one outer ring, and which these are."""
    counts = gather(view, starts[records] + 36, 8).view("<i4").reshape(-1, 2).astype(np.int64)
    rings = counts[:, 0]
    owner = np.repeat(np.arange(len(records)), rings)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(rings) - rings, rings)
    low = gather(view, starts[records][owner] + 44 + 4 * nth, 4).view("<i4").ravel().astype(np.int64)
    last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
    sizes = np.where(last, counts[owner, 1], np.append(low[1:], 0)[: len(owner)]) - low
    at = starts[records][owner] + 44 + 4 * rings[owner] + 16 * low
    is_area = codes[records] == 5
    # clockwise rings are outer
    is_outer = is_area[owner] & (_twice_areas(view, at, sizes, is_area[owner] & (rings[owner] > 1)) <= 0)
    outer = np.bincount(owner[is_outer], minlength=len(records))
    chosen = ~is_area | (outer == 1)
    kept = chosen[owner]
    owner, at, sizes, is_outer = owner[kept], at[kept], sizes[kept], is_outer[kept]
    # the outer ring comes first, whatever its place in the record
    order = np.lexsort((~is_outer, owner))
    at, sizes = at[order], sizes[order]
    number, areas = rings[chosen], is_area[chosen]
    kind = np.where(areas, wkb.POLYGON, np.where(number == 1, wkb.LINESTRING, wkb.MULTILINESTRING))
    each = np.ones(len(number), np.int64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    xy = doubles_at(view, np.repeat(at, sizes) + 16 * within, 2, "<f8")
    xyz = np.column_stack([xy, np.zeros(len(xy))])
    parts = Parts(np.arange(len(number)), each * 0, kind, offsets_of(each), offsets_of(number), offsets_of(sizes), xyz, np.zeros(len(xy), bool))
    return assemble(parts, len(number)), records[chosen]


def _twice_areas(view: np.ndarray, at: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Twice the signed area (clockwise is negative) of the wanted rings of points; 0 of others and of empty ones."""
    areas = np.zeros(len(at))
    some = np.flatnonzero(wanted & (sizes > 0))
    if not len(some):
        return areas
    at, sizes = at[some], sizes[some]
    first = np.cumsum(sizes) - sizes
    places = np.repeat(at - 16 * first, sizes) + 16 * np.arange(sizes.sum())
    points = doubles_at(view, places, 2, "<f8")
    x, y = (points - np.repeat(points[first], sizes, axis=0)).T
    cross = np.zeros(len(points))
    cross[:-1] = x[:-1] * y[1:] - x[1:] * y[:-1]
    cross[first + sizes - 1] = 0  # no edge from one ring to the next
    areas[some] = np.add.reduceat(cross, first)
    return areas


def _shape_wkb(data: bytes, at: int, end: int, code: int) -> bytes | None:
    """WKB of the shape record whose content is ``data[at:end]``."""
    if code == 0:
        return None
    if code in POINT_TYPES:
        return _point(data, at, end, code)
    if code in MULTIPOINT_TYPES:
        (count,) = struct.unpack_from("<i", data, at + 36)
        shape = _vertices(data, at + 40, count, end, code)
        head = shape.head(wkb.POINT)
        points = b"".join(head + shape.slice(i, i + 1) for i in range(count))
        return shape.head(wkb.MULTIPOINT) + struct.pack("<I", count) + points
    if code not in LINE_TYPES + POLYGON_TYPES:
        raise ValueError(f"Shape type {code} is not supported.")
    part_count, count = struct.unpack_from("<2i", data, at + 36)
    starts = struct.unpack_from(f"<{part_count}i", data, at + 44)
    shape = _vertices(data, at + 44 + 4 * part_count, count, end, code)
    parts = list(zip(starts, (*starts[1:], count)))
    runs = [struct.pack("<I", high - low) + shape.slice(low, high) for low, high in parts]
    if code in LINE_TYPES:
        return _one_or_many([shape.head(wkb.LINESTRING) + run for run in runs], shape, wkb.MULTILINESTRING)
    head = shape.head(wkb.POLYGON)
    polygons = [
        head + struct.pack("<I", len(rings)) + b"".join(runs[ring] for ring in rings)
        for rings in _rings_by_polygon(shape, parts)
    ]
    return _one_or_many(polygons, shape, wkb.MULTIPOLYGON)


class _Vertices(NamedTuple):
    """Interleaved coordinates of one shape and the dimensions they carry."""

    raw: bytes
    width: int
    has_z: bool
    has_m: bool

    def slice(self, low: int, high: int) -> bytes:
        return self.raw[low * self.width * 8 : high * self.width * 8]

    def head(self, base: int) -> bytes:
        return struct.pack("<BI", 1, wkb.type_code(base, self.has_z, self.has_m))

    def xy(self) -> np.ndarray:
        return np.frombuffer(self.raw, "<f8").reshape(-1, self.width)[:, :2]


def _one_or_many(parts: list[bytes], shape: _Vertices, many: int) -> bytes:
    return parts[0] if len(parts) == 1 else shape.head(many) + struct.pack("<I", len(parts)) + b"".join(parts)


def _point(data: bytes, at: int, end: int, code: int) -> bytes:
    values = struct.unpack_from(f"<{(end - at - 4) // 8}d", data, at + 4)
    has_z = code == 11
    measure = values[3:4] if has_z else values[2:3]
    has_m = code != 1 and bool(measure) and measure[0] > NO_DATA
    kept = values[:2] + (values[2:3] if has_z else ()) + (measure if has_m else ())
    return struct.pack(f"<BI{len(kept)}d", 1, wkb.type_code(wkb.POINT, has_z, has_m), *kept)


def _vertices(data: bytes, at: int, count: int, end: int, code: int) -> _Vertices:
    """Vertices that begin at ``at``; z and m values follow in blocks of their own."""
    after = at + count * 16
    if code < 10:
        return _Vertices(data[at:after], 2, False, False)
    has_z = code < 20
    blocks = []
    if has_z:
        blocks.append(np.frombuffer(data, "<f8", count, after + 16))
        after += 16 + count * 8
    has_m = False
    if after + 16 + count * 8 <= end:  # measures may be left out
        measures = np.frombuffer(data, "<f8", count, after + 16)
        has_m = bool((measures > NO_DATA).any())
        blocks += [measures] if has_m else []
    rows = np.empty((count, 2 + len(blocks)), "<f8")
    rows[:, :2] = np.frombuffer(data, "<f8", count * 2, at).reshape(-1, 2)
    for column, block in enumerate(blocks, 2):
        rows[:, column] = block
    return _Vertices(rows.tobytes(), 2 + len(blocks), has_z, has_m)


def _contains(ring: np.ndarray, point: np.ndarray) -> bool:
    x, y = ring[:, 0], ring[:, 1]
    crosses = (y[:-1] > point[1]) != (y[1:] > point[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (x[1:] - x[:-1]) * (point[1] - y[:-1]) / (y[1:] - y[:-1]) + x[:-1]
    return bool((crosses & (point[0] < at)).sum() % 2)


def _rings_by_polygon(shape: _Vertices, parts: list[tuple[int, int]]) -> list[list[int]]:
    """Group rings: clockwise ones are outer, the others go to the smallest outer around them."""
    if len(parts) < 2:
        return [list(range(len(parts)))]
    low, high = np.array(parts, np.int64).T
    raw = np.ascontiguousarray(shape.xy()).view(np.uint8).ravel()
    areas = _twice_areas(raw, 16 * low, high - low, np.ones(len(parts), bool)).tolist()
    outer = [i for i, area in enumerate(areas) if area <= 0]
    inner = [i for i, area in enumerate(areas) if area > 0]
    if len(outer) == 1:
        return [outer + inner]
    points = shape.xy()
    polygons = {i: [i] for i in outer}
    by_size = sorted((o for o in outer if parts[o][0] < parts[o][1]), key=lambda o: abs(areas[o]))
    low = np.array([points[slice(*parts[o])].min(axis=0) for o in by_size]).reshape(-1, 2)
    high = np.array([points[slice(*parts[o])].max(axis=0) for o in by_size]).reshape(-1, 2)
    for i in inner:
        at = points[parts[i][0]]
        holders = np.flatnonzero(((low <= at) & (at <= high)).all(axis=1))
        around = next((by_size[h] for h in holders if _contains(points[slice(*parts[by_size[h]])], at)), None)
        polygons.setdefault(i if around is None else around, []).append(i)
    return list(polygons.values())
