"""A local session and the small vector sources most tests read."""

from __future__ import annotations

import io
import os
import struct
import tarfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from featureframe.session import ship_package
from featureframe.testing.encode import shapefile_parts, table_part, write_geopackage

SCHEMA = StructType(
    [StructField("id", LongType()), StructField("category", StringType()), StructField("geometry", BinaryType())]
)
ATTRIBUTES = [("id", "bigint"), ("category", "string")]


def row(id: int, category: str | None, x: float | None, y: float | None, **more) -> dict:
    return {"fid": id, "id": id, "category": category, "x": x, "y": y, "layer": "first", **more}


# The layers (id, category, x, y) of the two sources
FIRST = [row(0, "A", 0.0, 0.0), row(1, "B", 1.0, 0.0)]
SECOND = [row(2, "C", 1.0, 1.0), row(3, "D", 0.0, 1.0)]
THIRD = [row(8, "H", None, None), row(9, "I", None, None)]
OTHER_FIRST = [row(4, "E", 1.0, 1.0), row(5, "F", 1.0, 2.0)]
OTHER_SECOND = [row(6, "G", 2.0, 2.0), row(7, "H", 2.0, 1.0)]


def point(x: float, y: float) -> bytearray:
    return bytearray(struct.pack("<BIdd", 1, 1, x, y))


def expected(rows: list[dict]) -> list[tuple]:
    return [(r["id"], r["category"], None if r["x"] is None else point(r["x"], r["y"])) for r in rows]


def collected(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select("id", "category", "geometry").collect())


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("featureframe tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    return session


def write_parts(base: Path, rows: list[dict], geometry: bool = True) -> None:
    base.parent.mkdir(parents=True, exist_ok=True)
    parts = shapefile_parts(rows, ATTRIBUTES) if geometry else {".dbf": table_part(rows, ATTRIBUTES)}
    for extension, data in parts.items():
        base.with_suffix(extension).write_bytes(data)


@pytest.fixture(scope="session")
def shapefiles(tmp_path_factory: pytest.TempPathFactory) -> str:
    root = tmp_path_factory.mktemp("shapefile")
    write_parts(root / "first", FIRST)
    write_parts(root / "second", SECOND)
    for name, rows in (("first", FIRST), ("second", SECOND)):
        with tarfile.open(root / f"{name}.tar.gz", "w:gz") as archive:
            for extension, data in shapefile_parts(rows, ATTRIBUTES).items():
                member = tarfile.TarInfo(name + extension)
                member.size = len(data)
                archive.addfile(member, io.BytesIO(data))
    return str(root)


@pytest.fixture(scope="session")
def folders(tmp_path_factory: pytest.TempPathFactory) -> str:
    """Two folders of shapefiles; ``third`` is a table without geometry."""
    root = tmp_path_factory.mktemp("folders")
    write_parts(root / "first.gdb" / "first", FIRST)
    write_parts(root / "first.gdb" / "second", SECOND)
    write_parts(root / "first.gdb" / "third", THIRD, geometry=False)
    write_parts(root / "second.gdb" / "first", OTHER_FIRST)
    write_parts(root / "second.gdb" / "second", OTHER_SECOND)
    return str(root)


def write_layers(path: str, layers: dict[str, list[dict]], attributes: list[tuple[str, str]] = ATTRIBUTES) -> str:
    rows = [{**r, "layer": name} for name, rows in layers.items() for r in rows]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    write_geopackage(path, rows, attributes)
    return path


@pytest.fixture
def geopackage(tmp_path: Path) -> str:
    return write_layers(str(tmp_path / "gpkg" / "first.gpkg"), {"first": FIRST, "second": SECOND})
