"""Smallest and largest ids, columns that do not compare, names with dots, texts that grow in lower case."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from featureframe.llm import exact_dedup, near_dedup, personal_data, toxicity

LEAST, MOST = -(1 << 63), (1 << 63) - 1
STORY = " ".join(f"word{n}" for n in range(80))


@pytest.fixture
def odd(spark):
    """Two exact copies of the smallest id, a near one, and another text; a map and names with dots beside."""
    rows = [
        (LEAST, STORY, {"b": 2, "a": 1}, 1),
        (MOST, STORY, {"c": 3}, 2),
        (0, STORY + " more", {}, 3),
        (5, "mail me at a.b@example.com", None, 4),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, `a.map` map<string, int>, `dotted.name` int")


def test_exact_copies(odd):
    found = {row.doc_id: (row.keep_id, row.group_size) for row in exact_dedup.find_duplicates(odd).collect()}
    assert found == {LEAST: (LEAST, 2), MOST: (LEAST, 2), 0: (0, 1), 5: (5, 1)}
    kept = exact_dedup.keep_first(odd)
    assert kept.schema.simpleString() == odd.schema.simpleString()
    rows = {row.doc_id: (row["a.map"], row["dotted.name"]) for row in kept.collect()}
    assert rows == {LEAST: ({"a": 1, "b": 2}, 1), 0: ({}, 3), 5: (None, 4)}


def test_near_copies(odd):
    found = {row.doc_id: row.component_id for row in near_dedup.find_near_duplicates(odd).collect()}
    assert found == {LEAST: LEAST, MOST: LEAST, 0: LEAST, 5: 5}
    assert {row["dotted.name"] for row in near_dedup.keep_one_of_each(odd).collect()} == {1, 4}


def test_personal_data(odd):
    clean = personal_data.sanitise(odd)
    assert clean.columns == odd.columns
    assert {row["dotted.name"]: row.text for row in clean.collect()}[4] == "mail me at [EMAIL]"


def test_labels_all_clean_keep_every_row(spark, odd):
    labels = spark.createDataFrame([(0, 0), (5, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels, learn=F.lit(True))
    assert {row.score for row in toxicity.score(odd, model).collect()} == {0.0}
    assert toxicity.drop_toxic(odd, model).count() == 4


def test_spans_are_places_of_the_text(spark):
    rows = [(n, "a plain story of the day" if n % 2 else "you knave. go away") for n in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels, learn=F.lit(True))
    text = "\u0130" * 4 + ". you knave here."
    row = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model, worst=0.0).first()
    assert [text[one.start : one.end] for one in row.sentences] == ["\u0130" * 4, " you knave here"]
    empty = toxicity.score(spark.createDataFrame([(1, "...")], "doc_id long, text string"), model).first()
    assert str(empty.score) == "0.0"
