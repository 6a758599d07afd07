from __future__ import annotations

import gzip
import os
import zipfile

import pytest

from featureframe import describe_layers, read_vector_files
from featureframe.sources.archive import archive_kind
from featureframe.testing.encode import shapefile_parts
from tests.conftest import ATTRIBUTES, FIRST, SECOND, collected, expected, write_layers


def test_kinds():
    assert [archive_kind(p) for p in ("/vsitar/", "vsizip", "/vsigzip/", "/vsigzip/vsitar/")] == ["tar", "zip", "gzip", "tar"]
    with pytest.raises(ValueError):
        archive_kind("/vsicurl/")


@pytest.mark.parametrize("strategy", ["files", "rows"])
def test_zip(spark, tmp_path, strategy):
    for name, rows in (("a", FIRST), ("b", SECOND)):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            for extension, data in shapefile_parts(rows, ATTRIBUTES).items():
                archive.writestr(f"folder/{name}{extension}", data)
    df = read_vector_files(str(tmp_path), suffix="zip", vsi_prefix="/vsizip/", concurrency_strategy=strategy, spark=spark)
    assert collected(df) == expected(FIRST + SECOND)


def test_members_of_one_name_in_two_folders(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        for folder, rows in (("x/", FIRST), ("x/../y/", SECOND)):
            for extension, data in shapefile_parts(rows, ATTRIBUTES).items():
                archive.writestr(f"{folder}a{extension}", data)
    df = read_vector_files(str(tmp_path), suffix="zip", vsi_prefix="/vsizip/", spark=spark)
    assert collected(df) == expected(FIRST + SECOND)


def test_gzipped_geopackage(spark, tmp_path):
    path = write_layers(str(tmp_path / "plain" / "a.gpkg"), {"first": FIRST})
    os.makedirs(tmp_path / "packed")
    with open(path, "rb") as plain, gzip.open(tmp_path / "packed" / "a.gpkg.gz", "wb") as packed:
        packed.write(plain.read())
    df = read_vector_files(str(tmp_path / "packed"), suffix="gz", vsi_prefix="/vsigzip/", spark=spark)
    assert collected(df) == expected(FIRST)


def test_broken_archive_beside_good_ones(spark, shapefiles, tmp_path):
    (tmp_path / "a.tar.gz").write_bytes(b"junk" * 100)
    with open(os.path.join(shapefiles, "first.tar.gz"), "rb") as good:
        data = good.read()
    (tmp_path / "b.tar.gz").write_bytes(data)
    (tmp_path / "c.tar.gz").write_bytes(data[: len(data) // 2])
    arguments = {"suffix": "gz", "vsi_prefix": "/vsitar/", "spark": spark}
    assert collected(read_vector_files(str(tmp_path), **arguments)) == expected(FIRST)
    catalog = describe_layers(str(tmp_path), **arguments)
    assert catalog.filter("error is not null").count() == 2
    assert catalog.filter("error is null").first()["layer_name"] == "first"
