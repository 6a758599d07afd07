"""A corpus from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it works on all its
predecessor kept. All but the last return the columns of ``docs``. ``run`` writes every
stage to the shared folder and reads it again, so a lost executor never costs more than
the stage it worked on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureframe.llm import exact_dedup, near_dedup, packing, personal_data, toxicity
from featureframe.session import new_shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go; it learns from the labels of those given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, learn=F.lit(True)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, four fifths of them shared."""
    return near_dedup.keep_one_of_each(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal_data.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: where it is in its document and in its sequence."""
    _, placed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("personal_data", sanitise),
    ("packing", pack),
]

#: Learned scores and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
