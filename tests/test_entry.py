"""Every registered query against its SQL equivalent."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    return connection


def test_every_sql_has_its_query():
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_readers_work_without_the_corpus_operators(monkeypatch):
    every = entry.queries()
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    alone = entry.queries()
    assert alone.keys() == {name for name in every if name.startswith("q_")}
    assert entry.oracle_sql().keys() <= alone.keys()


def ordered(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query(spark, tables, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = ", ".join(f'"{column}"' for column in df.columns)
    expected = tables.execute(f"select {columns} from ({entry.oracle_sql()[name]})").fetchall()
    assert len(df.columns) == len(tables.execute(entry.oracle_sql()[name]).description)
    assert ordered(map(tuple, df.collect())) == ordered(expected)


def test_flagship(spark):
    assert entry.entry(spark).count() == 5
