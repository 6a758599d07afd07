"""The corpus operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureframe.llm import (
    byte_pairs,
    exact_dedup,
    language,
    line_dedup,
    merkle,
    near_dedup,
    nearest,
    packing,
    personal_data,
    spelling,
    sql,
    substring_dedup,
    token_files,
    toxicity,
)
from featureframe.llm.common import id_remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2
    )
    return token_files.read_documents(manifest, with_ids=False)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_shared_passages(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, placed = packing.pack_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return placed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.find_near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_duplicates(_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_pairs.encode(_table(spark, sf_dir, "documents"), ranks, pattern)
    return byte_pairs.decode(encoded, ranks, pattern).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_block_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


#: Documents whose id has this remainder are held out of training.
_TOXIC_FOLDS, _TOXIC_HELD_OUT = 5, 0


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    remainder = id_remainder(_TOXIC_FOLDS)
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), learn=remainder != _TOXIC_HELD_OUT)
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(remainder == _TOXIC_HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(_table(spark, sf_dir, "documents"))
    rows = personal_data.described(found)
    base = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", base, "spans")


_LANG_FOLDS, _LANG_HELD_OUT = 4, 2


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    remainder = id_remainder(_LANG_FOLDS)
    model = language.train(docs, learn=remainder != _LANG_HELD_OUT)
    return language.predict(docs, model).select(
        "doc_id", F.coalesce(remainder == _LANG_HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


#: One in so many words of a document is misspelt before words are counted.
_MISSPELT = 199


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(_table(spark, sf_dir, "documents"), least_points=6, least_count=5, alter_one_in=_MISSPELT)
    return spelling.group_variants(words, least_points=6, least_ratio=5)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    kept = line_dedup.kept_lines(docs, line_dedup.keep_bitmaps(docs, least_points=20, least_documents=3))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    tampered = merkle.leaf({"text": F.coalesce(text, F.col("text"))})
    rows = merkle.manifest(_table(spark, sf_dir, "documents"), tampered=tampered)
    folded = merkle.folded(F.col("tampered"), F.col("path"))
    proof = F.sha2(merkle.proof(F.col("path")).cast("binary"), 256).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_packing": op3_packing,
    "op4_minhash": op4_minhash,
    "op5_block_join": op5_block_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_personal_data": op8_personal_data,
    "op9_language": op9_language,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling": op11_spelling,
    "op12_line_dedup": op12_line_dedup,
    "op13_merkle": op13_merkle,
}

ORACLE: dict[str, str] = {
    "op5_block_join": """
        with vectors as (
            select vec_id, embedding::double[] as v from embeddings
            where len([x for x in embedding if x is null or not isfinite(x)]) = 0
              and len([x for x in embedding if x <> 0]) > 0
        ), ranked as (
            select q.vec_id as query_id, c.vec_id as vec_id, list_inner_product(q.v, c.v) as score,
                   row_number() over (partition by q.vec_id order by list_inner_product(q.v, c.v) desc, c.vec_id) as rank
            from vectors q join vectors c on c.vec_id <> q.vec_id
            where q.vec_id % 20 = 0
        )
        select query_id, cast(rank as int) as rank, vec_id, score from ranked where rank <= 20
    """,
    "op6_exact_dedup": r"""
        with rows as (
            select doc_id, length(coalesce(text, '')) as points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as plain
            from documents
        ), ranked as (
            select *, first_value(doc_id) over (partition by plain order by points desc, doc_id) as keep_id,
                   count(*) over (partition by plain) as group_size
            from rows
        )
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(plain) as text_sha256 from ranked
    """,
    "op11_spelling": sql.spelling(),
    "op12_line_dedup": sql.line_dedup(),
    "op13_merkle": sql.merkle(),
}
