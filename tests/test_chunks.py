from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from featureframe.plans.chunks import (
    _bytes,
    chunk_table,
    id_ranges,
    place_by_size,
    place_evenly,
    plan_chunks,
    total_chunks,
    with_dense_id,
)
from featureframe.session import settle


def layers(spark, *counts):
    rows = [(f"/path/{i}", "first", count) for i, count in enumerate(counts)]
    return spark.createDataFrame(rows, "path string, layer_name string, feature_count bigint")


@pytest.mark.parametrize(
    ("count", "size", "chunks"),
    [
        (2, 2, [(0, 3)]),
        (2, 1, [(0, 1), (1, 3)]),
        (4, 2, [(0, 2), (2, 5)]),
        (5, 2, [(0, 2), (2, 4), (4, 6)]),
        (1, 1_000_000, [(0, 2)]),
        (0, 10, []),
    ],
)
def test_plan_chunks(spark, count, size, chunks):
    planned = plan_chunks(layers(spark, count), size)
    assert [(r["start"], r["stop"]) for r in planned.orderBy("start").collect()] == chunks
    assert total_chunks(layers(spark, count), size).first()[0] == len(chunks)


def test_plan_chunks_equals_brute_force(spark):
    for size in (1, 3, 7):
        counts = list(range(0, 23))
        planned = plan_chunks(layers(spark, *counts), size).collect()
        for i, count in enumerate(counts):
            bounds = [*range(0, count, size), count + 1]
            found = sorted((r["start"], r["stop"]) for r in planned if r["path"] == f"/path/{i}")
            assert found == list(zip(bounds, bounds[1:]))


def test_total_chunks_over_layers(spark):
    assert total_chunks(layers(spark, 2, 1, 0), 1).first()[0] == 3


def test_chunk_table_schema_and_dense_ids(spark):
    table = chunk_table(layers(spark, 2, 0, 3), 1, ["path", "layer_name"])
    assert table.schema.simpleString() == "struct<path:string,layer_name:string,id:bigint,start:bigint,stop:bigint>"
    assert [tuple(r) for r in table.orderBy("id").collect()] == [
        ("/path/0", "first", 0, 0, 1),
        ("/path/0", "first", 1, 1, 3),
        ("/path/2", "first", 2, 0, 1),
        ("/path/2", "first", 3, 1, 2),
        ("/path/2", "first", 4, 2, 4),
    ]


def test_dense_ids_follow_the_order_over_many_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k")).orderBy("k")
    rows = with_dense_id(settle(df), "id").collect()
    assert sorted((r["k"], r["id"]) for r in rows) == [(i, i) for i in range(1000)]


def test_sources_are_packed_by_size(spark):
    lengths = [1000 << 20] + [1 << 20] * 400
    df = spark.createDataFrame([(f"/p/{i}", n) for i, n in enumerate(lengths)], "path string, length bigint")
    placed = place_by_size(df, sum(lengths), len(lengths))
    sizes = placed.groupBy(F.spark_partition_id()).agg(F.sum("length").alias("bytes"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in sizes) == 401
    others = [r["bytes"] for r in sizes if r["bytes"] < 1000 << 20]
    assert max(others) <= 128 << 20
    assert max(others) - min(others) <= 1 << 20


@pytest.mark.parametrize(("text", "size"), [("134217728b", 128 << 20), ("128MB", 128 << 20), ("4m", 4 << 20), ("77", 77)])
def test_size_notation(text, size):
    assert _bytes(text) == size


def ranges(spark, first, last, starts, size):
    catalog = spark.createDataFrame(
        [("p", "geopackage", "l", first, last, starts)],
        "path string, source string, layer_name string, first_id bigint, last_id bigint, range_starts array<bigint>",
    )
    return sorted((r["start"], r["stop"]) for r in id_ranges(catalog, size).collect())


def test_id_ranges_cover_first_to_last(spark):
    assert ranges(spark, 0, 4, None, 2) == [(0, 2), (2, 4), (4, 5)]
    assert ranges(spark, 1, 4, None, 2) == [(1, 3), (3, 5)]
    assert ranges(spark, -3, 0, None, 10) == [(-3, 1)]


def test_id_ranges_of_sparse_empty_and_unranged_layers(spark):
    assert ranges(spark, 5, 9_000_000, [5, 70, 400], 2) == [(5, 70), (70, 400), (400, 9_000_001)]
    assert ranges(spark, 0, -1, None, 2) == []
    assert ranges(spark, None, None, None, 2) == [(None, None)]


def test_one_range_per_partition(spark):
    rows = [(f"/p/{i // 3}", "geopackage", "l", i % 3, i % 3 + 1) for i in range(64)]
    df = spark.createDataFrame(rows, "path string, source string, layer_name string, start bigint, stop bigint")
    placed = place_evenly(df)
    sizes = placed.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 64
    assert {r["count"] for r in sizes} == {1}


def test_no_ranges_still_give_a_frame(spark):
    df = spark.createDataFrame([], "path string, source string, layer_name string, start bigint, stop bigint")
    assert place_evenly(df).count() == 0
