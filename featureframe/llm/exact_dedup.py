"""Exact duplicates: texts that are equal once white space is deleted.

Rows meet by a 128-bit content hash; inside a hash, groups are told apart by the
bytes of the normalised text itself, so a collision never joins two texts. Both
aggregations combine on the map side, so a text that a third of all rows hold sends
one row per task. The join that tells every row its group is on the hash and
sha256; a hot group there is an ordinary skewed join, which adaptive execution splits.

Null texts count as empty; all empty texts are one group. Null ids are larger than
any id. Rows that repeat an id share its answer. Tables without rows give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from featureframe.llm.common import ids_and_texts

#: Fixed value: the white space that does not count.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def _normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_SPACE, "")


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _best(extra: list[str] = ()) -> Column:
    """Largest for the most code points, then the smallest id; null ids come last."""
    return F.max(F.struct(F.length("text").alias("points"), F.bitwise_not("doc_id").alias("downwards"), *extra))


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """``content``, ``text_sha256``, ``keep_id``, ``group_size`` of each distinct normalised text."""
    rows = ids_and_texts(docs).withColumn("plain", _normalised(F.col("text")))
    return (
        rows.withColumn("content", _hash(F.col("plain")))
        .groupBy("content", "plain")
        .agg(_best().alias("best"), F.count("*").alias("group_size"))
        .select(
            "content",
            F.sha2(F.col("plain").cast("binary"), 256).alias("text_sha256"),
            F.bitwise_not("best.downwards").alias("keep_id"),
            "group_size",
        )
    )


def find_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    plain = _normalised(F.col("text"))
    rows = (
        ids_and_texts(docs)
        .withColumn("plain", plain)
        .select("doc_id", _hash(F.col("plain")).alias("content"), F.sha2(F.col("plain").cast("binary"), 256).alias("text_sha256"))
    )
    groups = duplicate_groups(docs).filter("group_size > 1")
    return rows.join(groups, ["content", "text_sha256"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The row of each group that stays, with all its columns; one row also where ids repeat.

    Of rows alike in length and id the largest stays, column by column; maps compare as their sorted entries.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = _normalised(text)
    maps = [isinstance(field.dataType, MapType) for field in docs.schema]
    own = [F.col(f"`{name.replace('`', '``')}`") for name in docs.columns]
    # names of columns may have dots, and be anything
    places = [f"c{n}" for n in range(len(own))]
    row = [(F.array_sort(F.map_entries(one)) if is_map else one).alias(at) for one, is_map, at in zip(own, maps, places, strict=True)]
    order = F.struct(
        F.length(text).alias("points"), F.bitwise_not(F.col("doc_id").cast("long")).alias("downwards"), F.struct(*row).alias("row")
    )
    kept = (
        docs.select(plain.alias("plain"), order.alias("order"))
        .groupBy(_hash(F.col("plain")).alias("content"), "plain")
        .agg(F.max("order").alias("order"))
    )
    found = [F.col(f"order.row.{at}") for at in places]
    return kept.select(
        *((F.map_from_entries(one) if is_map else one).alias(name) for one, is_map, name in zip(found, maps, docs.columns, strict=True))
    )
