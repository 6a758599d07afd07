from __future__ import annotations

import pytest

from featureframe.sources.listing import archive_paths, find_sources, list_files, list_folders


def names(df):
    return sorted(row["path"].rsplit("/", 1)[-1] for row in df.collect())


@pytest.mark.parametrize(("pattern", "found"), [("*", ["first.gdb", "second.gdb"]), ("first*", ["first.gdb"])])
@pytest.mark.parametrize("suffix", ["gdb", ".gdb"])
def test_folders_by_pattern(spark, folders, pattern, found, suffix):
    assert names(list_folders(folders, pattern, suffix, spark=spark)) == found


@pytest.mark.parametrize(
    ("pattern", "suffix", "recursive", "found"),
    [
        ("*", "ext", False, ["file_0000.ext", "file_1.ext"]),
        ("*", ".ext", False, ["file_0000.ext", "file_1.ext"]),
        ("*", "ext", True, ["file_0000.ext", "file_1.ext", "file_2.ext", "file_3.ext"]),
        ("*[0-9][0-9][0-9][0-9]", "ext", True, ["file_0000.ext"]),
        ("file_?", "ext", True, ["file_1.ext", "file_2.ext", "file_3.ext"]),
        ("*", "*", False, ["file_0000.ext", "file_1.ext", "other.txt"]),
    ],
)
def test_files_by_pattern(spark, tmp_path, pattern, suffix, recursive, found):
    # a folder named like a partition must count as a plain subfolder
    for name in ("file_0000.ext", "file_1.ext", "other.txt", "sub/file_2.ext", "key=1/file_3.ext"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    assert names(list_files(str(tmp_path), pattern, suffix, recursive, spark)) == found


def test_folder_name_with_blanks_and_wildcards(spark, tmp_path):
    folder = tmp_path / "a b [1]"
    folder.mkdir()
    (folder / "x%20y.ext").write_text("x")
    assert [row["path"] for row in list_files(str(folder), suffix="ext", spark=spark).collect()] == [
        str(folder / "x%20y.ext")
    ]


def test_not_a_directory(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    for path in (tmp_path / "file", tmp_path / "absent"):
        with pytest.raises(NotADirectoryError):
            find_sources(str(path), spark=spark)


def test_nothing_found_names_the_arguments(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="pattern='a', suffix='b', recursive=True"):
        find_sources(str(tmp_path), "a", "b", True, spark)


@pytest.mark.parametrize("prefix", ["/vsigzip/", "vsigzip", "/vsigzip", "vsigzip/"])
def test_archive_paths(spark, prefix):
    paths = spark.createDataFrame([("/a/first.gdb",), ("/a/second.gdb",)], "path string")
    assert [row["path"] for row in archive_paths(paths, prefix).collect()] == [
        "/vsigzip//a/first.gdb",
        "/vsigzip//a/second.gdb",
    ]


def test_names_spark_leaves_out(spark, tmp_path):
    for name in ("_a.gpkg", ".b.gpkg", "c.gpkg", "_d/e.gpkg", ".f/g/h.gpkg", "k=_1/i.gpkg", "_l.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_text("x")
    assert names(list_files(str(tmp_path), suffix="gpkg", spark=spark)) == [".b.gpkg", "_a.gpkg", "c.gpkg"]
    below = names(list_files(str(tmp_path), suffix="gpkg", recursive=True, spark=spark))
    assert below == [".b.gpkg", "_a.gpkg", "c.gpkg", "e.gpkg", "h.gpkg", "i.gpkg"]
    assert names(list_files(str(tmp_path), "_?", "{gpkg,txt}", spark=spark)) == ["_a.gpkg", "_l.txt"]


def test_a_flat_listing_does_not_look_below(spark, tmp_path):
    (tmp_path / "a.gpkg").write_text("x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.gpkg").write_text("x")
    assert list_files(str(tmp_path), suffix="gpkg", spark=spark).inputFiles() == [f"file://{tmp_path}/a.gpkg"]
