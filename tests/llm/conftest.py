"""Documents with every awkward case, and empty tables of the same columns."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

#: Other columns carry names the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, block int, key string, content string, node long,"
    " score double, rank int, part int, plain string, best int, row string, start long, length int, task int"
)
EXTRA = (1, "k", "c", 2, 0.5, 3, 4, "p", 5, "r", 6, 7, 8)

PASSAGE = " ".join(f"shared{n}" for n in range(30))
STORY = " ".join(f"word{n % 97} and{n % 89}" for n in range(400))

TEXTS = [
    (1, "The quick brown fox, 3 times!\nIt's gone"),
    (2, "The quick  brown fox,\t3 times! It's gone"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "one"),
    (7, f"before {PASSAGE} after"),
    (8, f"{PASSAGE} other end"),
    (9, STORY),
    (10, STORY + " one more"),
    (11, "ſtraße ÉCOLE İstanbul 東京 😀 ​x  é́ \x1c <|endoftext|>"),
    (12, "a" * 30_000),
    (13, " " * 30_000 + "x"),
    (14, "word " * 20_000),
    (15, "mail a.b+c@mail4.example.com or 97.51.17.173 or +1 (017) 555-7713, card 4929 3489 3854 630"),
    (15, "mail a.b+c@mail4.example.com or 97.51.17.173 or +1 (017) 555-7713, card 4929 3489 3854 630"),
    (16, "the same id"),
    (16, "with another text"),
    (None, "no id at all"),
    (-5, f"{PASSAGE}"),
    (1 << 60, "The quick brown fox,3 times!It's gone"),
]


def documents(spark: SparkSession, texts) -> DataFrame:
    rows = [(doc_id, text, "en", "src0", *EXTRA) for doc_id, text in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def docs(spark) -> DataFrame:
    return documents(spark, TEXTS)


@pytest.fixture(scope="session")
def no_docs(spark) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda texts: documents(spark, texts)
