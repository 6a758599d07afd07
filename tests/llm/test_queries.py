"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from featureframe.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SCHEMA

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLE])
def test_every_document_is_answered(spark, name):
    rows = QUERIES[name](spark, SF_DIR)
    assert rows.select("doc_id").distinct().count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns
        assert 0 < kept.count() <= before.count()
    assert "[EMAIL]" in " ".join(row.text for row in kept.collect())


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and max(row.offset + row.length for row in rows) <= 4096


def test_pipeline_of_awkward_documents(spark, docs, tmp_path):
    for name, frame in (("some", docs), ("none", spark.createDataFrame([], SCHEMA))):
        folder = str(tmp_path / name)
        frame.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 0), (9, 1)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert (found.count() > 0) == (name == "some")
