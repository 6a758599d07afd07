"""What the corpus operators share: columns, words, chunks of text, hashes.

All operators read only the columns they name, so other columns, also ones with
names used here, never clash.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space is left to the side of the word after it. A cut before a blank or a line
#: break that follows a visible character never falls inside a match of the patterns
#: byte-level tokenizers split text by: no alternative goes on from a visible character to
#: white space, and none looks back.
_CUT = re.compile(r"(?<=[\x21-\x7e\xc0-ɏ])(?=[ \n])")


def ids_and_texts(docs: DataFrame, fill: bool = True) -> DataFrame:
    """``doc_id`` as long and ``text``; null texts become empty unless ``fill`` is off."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(text, F.lit("")) if fill else text).alias("text")
    )


def id_remainder(divisor: int) -> Column:
    """crc32 of ``doc_id`` as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_file(spark: SparkSession, path: str):
    """Content of a vocabulary file of a few MB, for executors that may not have it."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


#: Bits of a map of hashed values: 2 MB, whatever the corpus.
SLOT_BITS = 24


def slot_map(slots: DataFrame) -> np.ndarray:
    """Bytes of a bitmap with the bits of a column ``slot`` (0 to ``2**SLOT_BITS - 1``) set."""
    # bitmaps count from 1 on
    numbered = slots.select((F.col("slot").cast("long") + 1).alias("slot")).distinct()
    bits = numbered.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    found = np.zeros((1 << SLOT_BITS) // 8, np.uint8)
    for row in bits.collect():
        found[(row["bucket"] - 1) * 4096 : row["bucket"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    return found


def in_slot_map(found: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (found[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def chunks(text: str) -> list[str]:
    """``text`` in pieces a pattern-splitting tokenizer can encode one by one."""
    return _CUT.split(text)


def words(text: str | None) -> list[bytes]:
    """Runs of other characters than ``[\\x20\\x09-\\x0D]``, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
