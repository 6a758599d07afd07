"""Reading by a box: the same rows as a filter on bounds, and fewer records decoded."""

from __future__ import annotations

import random
import struct

import numpy as np
import pyarrow as pa
import pytest

from featureframe import read_vector_files
from featureframe.functions import wkb
from featureframe.functions.boxes import Box, box_of
from featureframe.functions.buffers import binary_layout
from featureframe.sources import geopackage, shapefile
from featureframe.testing.encode import write_geojson, write_geopackage, write_gml, write_shapefile
from tests import geometries
from tests.conftest import ATTRIBUTES

BOX = (10.0, -20.0, 30.0, -5.0)


def rows(shape: str | None) -> list[dict]:
    """A row on each place of a grid, and some without geometry."""
    found = []
    for n in range(900):
        x, y = (None, None) if n % 50 == 7 else (float(n % 30) * 2, -float(n // 30) * 2)
        found.append({"fid": n, "id": n, "category": f"c{n}", "x": x, "y": y, "layer": "grid", "shape": shape})
    return found


def near(one: dict, box=BOX) -> bool:
    size = 4 if one["shape"] == "polygon" else 0
    if one["x"] is None:
        return False
    return one["x"] <= box[2] and one["x"] + size >= box[0] and one["y"] <= box[3] and one["y"] + size >= box[1]


WRITERS = {
    "gpkg": write_geopackage,
    "indexed.gpkg": lambda *arguments: write_geopackage(*arguments, indexed=True),
    "shp": write_shapefile,
    "geojson": write_geojson,
    "gml": write_gml,
}


def written(folder, kind: str, shape: str | None) -> str:
    path = str(folder / f"grid.{kind}")
    WRITERS[kind](path, rows(shape), ATTRIBUTES)
    return str(folder)


@pytest.mark.parametrize("kind", WRITERS)
@pytest.mark.parametrize("shape", [None, "polygon"])
@pytest.mark.parametrize("strategy", ["files", "rows"])
def test_rows_near_a_box(spark, tmp_path, kind, shape, strategy):
    folder = written(tmp_path, kind, shape)
    read = lambda **more: read_vector_files(folder, suffix=kind.split(".")[-1], spark=spark, concurrency_strategy=strategy, ideal_chunk_size=100, **more)
    found = read(bbox=BOX)
    assert found.columns == read().columns
    expected = [one for one in rows(shape) if near(one)]
    assert 50 < len(expected) < 200
    assert sorted((row["id"], row["category"]) for row in found.collect()) == [(one["id"], one["category"]) for one in expected]
    without = read(bbox=BOX, schema=read().select("id").schema)
    assert sorted(row["id"] for row in without.collect()) == [one["id"] for one in expected]
    assert read(bbox=(1000, 1000, 1001, 1001)).count() == 0


def test_fewer_records_are_decoded(tmp_path, monkeypatch):
    """Of shapefiles and GeoPackages only what is near; of indexed GeoPackages only that is fetched."""
    box, expected = box_of(BOX), sum(map(near, rows("polygon")))
    decoded = {"shapes": 0, "blobs": 0, "fetched": 0}
    to_wkb, from_blob, corners = shapefile._to_wkb, geopackage._wkb, geopackage._corners

    def count(name, function, size):
        def counted(*arguments):
            decoded[name] += size(*arguments)
            return function(*arguments)

        return counted

    monkeypatch.setattr(shapefile, "_to_wkb", count("shapes", to_wkb, lambda data, starts, sizes: len(starts)))
    monkeypatch.setattr(geopackage, "_wkb", count("blobs", from_blob, lambda blob: 1))
    monkeypatch.setattr(geopackage, "_corners", count("fetched", corners, len))
    for kind, reader, name in (("shp", shapefile, "shapes"), ("gpkg", geopackage, "blobs"), ("indexed.gpkg", geopackage, "blobs")):
        written(tmp_path, kind, "polygon")
        path = str(tmp_path / f"grid.{kind}")
        decoded.update(shapes=0, blobs=0, fetched=0)
        layer = reader.layer_names(path)[0]
        assert sum(rows.count for rows in reader.batches(path, layer, None, None, None, box)) == expected
        assert decoded[name] == expected
        if reader is geopackage:
            assert decoded["fetched"] == (expected if kind == "indexed.gpkg" else 900)


def test_a_shapefile_away_from_the_box_is_not_read(tmp_path, monkeypatch):
    written(tmp_path, "shp", "polygon")
    path = tmp_path / "grid.shp"
    data = bytearray(path.read_bytes())
    data[36:68] = struct.pack("<4d", 0, -60, 62, 4)
    path.write_bytes(data)
    monkeypatch.setattr(shapefile._Shapes, "_records", lambda *_: pytest.fail("records are read"))
    assert list(shapefile.batches(str(path), "grid", None, None, None, box_of((100, 100, 101, 101)))) == []


def test_r_tree_rounding_does_not_add_rows(tmp_path):
    """The index holds single precision, rounded outwards."""
    path = str(tmp_path / "a.gpkg")
    one = {"fid": 1, "id": 1, "category": "a", "x": 0.1, "y": 0.1, "layer": "a"}
    write_geopackage(path, [one], ATTRIBUTES, indexed=True)
    at = np.nextafter(0.1, 1)
    assert list(geopackage.batches(path, "a", None, None, None, Box(at, 0.0, 1.0, 1.0))) == []
    assert len(list(geopackage.batches(path, "a", None, None, None, Box(0.1, 0.1, 0.1, 0.1)))) == 1


@pytest.mark.parametrize("bbox", [(1, 0, 0, 1), (0, 1, 1, 0), (0, 0, float("nan"), 1), (0, 0, 1)])
def test_boxes_that_are_none(spark, tmp_path, bbox):
    with pytest.raises((ValueError, TypeError)):
        read_vector_files(str(tmp_path), bbox=bbox, spark=spark)


def test_corners_of_random_geometries():
    """All at once as one by one, with the other byte order, measures and single ones among them."""
    chance = random.Random(5)
    values = [geometries._from_object(geometries.random_geojson(chance)) for _ in range(600)]
    values += [None, struct.pack(">BIdd", 0, 1, 1, 2), struct.pack("<BI4d", 1, 3001, 1, 2, 3, 4), struct.pack("<BIIdd", 1, 8, 1, 5, 6)]
    values += [struct.pack("<BIdd", 1, 1, float("nan"), 1), struct.pack("<BII", 1, 7, 0), struct.pack("<BIII4d", 1, 3, 1, 2, 1, float("nan"), 3, 4)]
    array = pa.array(values, pa.binary())
    expected = [[np.nan] * 4 if value is None else wkb._bounds(value) for value in values]
    assert np.array_equal(wkb.corners(*binary_layout(array)), expected, equal_nan=True)
    few = array.slice(590)
    assert np.array_equal(wkb.corners(*binary_layout(few)), expected[590:], equal_nan=True)
