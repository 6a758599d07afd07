"""Passages that documents share, by an index of all phrases of all reference blocks.

The method this stands for is relative Lempel-Ziv parsing. What is kept of it: every block is
an indexed reference, factors are found greedily from left to right, and phrases across
their ends are checked. What is not: a factor names no place in a reference. That would
take the place of every phrase of the corpus through the shuffle beside its hash, about half
as much again of what is the largest shuffle here, beyond the disk this is allowed.

Every block of documents is a reference for all documents of larger ids. Its index
holds each phrase of ``WINDOW`` words that starts in it, with the smallest id of the
block's documents that have it. The index is split over tasks by a hash of the phrase,
so a document's phrases are looked up in the indexes of all blocks at once, and a
passage that a third of all documents share adds one entry per block, not per document.

A document is then parsed greedily. A factor starts where a phrase is found and grows by
a word while the phrase that ends there is found too; words in between are literals.
Phrases that straddle the end of a factor are looked up like all others, so words
covered by a phrase from any earlier document are always part of a factor, and no other
words are. Factors are judged on the input, not on what is left of it.

Phrases are compared by a 64-bit hash within one of B parts of the index, and the part
comes from a second hash. B grows with the number of phrases, so the expected number of
wrong matches in a whole corpus stays below one up to about 10**14 words.

Words are runs of other characters than ``[\\x20\\x09-\\x0D]``, compared as they are. A
null text has none. Texts shorter than a phrase are kept whole. Rows that repeat an id
are documents of that id, none earlier than the other; null ids come before all others.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureframe.llm.common import ids_and_texts, shuffle_partitions, word_hashes, words
from featureframe.session import ship_package

WINDOW = 13
#: Bytes of text of one block, and phrases of one part of the index: what one task holds at a time.
BLOCK_BYTES = 4_000_000
PART_PHRASES = 2_500_000

_FACTORS = "array<struct<start:int,length:int>>"
_FACTORS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
_NO_ID = np.iinfo(np.int64).min


class _Block:
    """The phrases of one block of documents, in a fixed order."""

    def __init__(self, ids: list[int | None], texts: list[str | None], window: int, parts: int):
        order = sorted(range(len(ids)), key=lambda row: (_NO_ID if ids[row] is None else ids[row], texts[row] or ""))
        self.rows = order
        self.ids = np.array([_NO_ID if ids[row] is None else ids[row] for row in order], np.int64)
        self.words = [words(texts[row]) for row in order]
        self.window = window
        sizes = np.array([len(found) for found in self.words], np.int64)
        self.first_word = np.concatenate([[0], np.cumsum(sizes)])
        hashes = word_hashes([word for found in self.words for word in found])
        starts = np.maximum(sizes - window + 1, 0)
        #: Document and first word of every phrase.
        self.doc = np.repeat(np.arange(len(order)), starts)
        within = np.arange(len(self.doc)) - np.repeat(np.cumsum(starts) - starts, starts)
        self.word = self.first_word[self.doc] + within
        phrase = _rolling(hashes, window, 0x9E3779B97F4A7C15)[self.word] if len(self.word) else np.zeros(0, np.uint64)
        part = _rolling(hashes, window, 0xC2B2AE3D27D4EB4F)[self.word] if len(self.word) else np.zeros(0, np.uint64)
        part = (part >> np.uint64(20)) % np.uint64(parts)
        # documents are in order of their ids, so the first of equal phrases has the smallest
        sort = np.argsort(phrase, kind="stable")
        ordered = phrase[sort]
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first = sort[new]
        #: For every phrase, which distinct phrase it is.
        self.distinct = np.empty(len(phrase), np.int64)
        self.distinct[sort] = np.cumsum(new) - 1
        self.first_doc = self.doc[first]
        self.hash = phrase[first]
        self.part = part[first].astype(np.int64)
        #: Distinct phrases by part, then document: the order entries are sent in.
        self.sent = np.lexsort((self.first_doc, self.part))


def _rolling(hashes: np.ndarray, window: int, factor: int) -> np.ndarray:
    """A polynomial hash of the ``window`` words from each word on, modulo 2**64."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for step in range(1, window):
        total *= np.uint64(factor)
        total += hashes[step : step + n]
    total ^= total >> np.uint64(29)
    return total * np.uint64(0xBF58476D1CE4E5B9)


def _index_entries(window: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        block = _Block(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), window, parts)
        # only parts the block has phrases of, so its work does not grow with their number
        own_parts, starts = np.unique(block.part[block.sent], return_index=True)
        rows = []
        for part, entries in zip(own_parts.tolist(), np.split(block.sent, starts[1:]), strict=True) if len(own_parts) else ():
            docs, counts = np.unique(block.first_doc[entries], return_counts=True)
            rows.append((part, block.hash[entries].tobytes(), block.ids[docs].tobytes(), counts.astype(np.int32).tobytes()))
        number = table.column("block")[0].as_py()
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        return pa.table(
            {
                "part": pa.array(columns[0], pa.int32()),
                "block": pa.array([number] * len(rows), pa.int64()),
                "phrases": pa.array(columns[1], pa.binary()),
                "ids": pa.array(columns[2], pa.binary()),
                "counts": pa.array(columns[3], pa.binary()),
            }
        )

    return run


def _look_up(table: pa.Table) -> pa.Table:
    """For each block, which of its phrases start in a document with a smaller id than its own first."""
    phrases = [np.frombuffer(value.as_py(), np.uint64) for value in table.column("phrases")]
    ids = [
        np.repeat(np.frombuffer(own.as_py(), np.int64), np.frombuffer(count.as_py(), np.int32))
        for own, count in zip(table.column("ids"), table.column("counts"), strict=True)
    ]
    phrase, first_id = np.concatenate(phrases), np.concatenate(ids)
    sort = np.argsort(phrase)
    ordered = phrase[sort]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    smallest = np.minimum.reduceat(first_id[sort], np.flatnonzero(new))
    earlier = np.empty(len(ordered), bool)
    earlier[sort] = first_id[sort] > smallest[np.cumsum(new) - 1]
    ends = np.cumsum([len(one) for one in phrases])
    bits = [np.packbits(found).tobytes() for found in np.split(earlier, ends[:-1])]
    return pa.table(
        {"block": table.column("block"), "part": table.column("part"), "found": pa.array(bits, pa.binary())}
    )


def _factors(covered: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return [{"start": int(a), "length": int(b - a)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _parse(window: int, parts: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids = docs.column("doc_id").to_pylist()
        block = _Block(ids, docs.column("text").to_pylist(), window, parts)
        earlier = np.zeros(len(block.hash), bool)
        by_part = block.part[block.sent]
        for part, found in zip(answers.column("part").to_pylist(), answers.column("found"), strict=True):
            entries = block.sent[slice(*np.searchsorted(by_part, [part, part + 1]))]
            bits = np.frombuffer(found.as_py(), np.uint8)
            earlier[entries] = np.unpackbits(bits, count=len(entries)).astype(bool)
        found = earlier[block.distinct] | (block.ids[block.doc] > block.ids[block.first_doc][block.distinct])
        # a word is covered if one of the phrases that reach it is found
        change = np.zeros(block.first_word[-1] + 1, np.int64)
        np.add.at(change, block.word[found], 1)
        np.add.at(change, block.word[found] + window, -1)
        covered = np.cumsum(change[:-1]) > 0
        kept, removed, factors = [], [], []
        for number, found_words in enumerate(block.words):
            own = covered[block.first_word[number] : block.first_word[number + 1]]
            n = int(own.sum())
            removed.append(n)
            left = compress(found_words, ~own) if n else found_words
            kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            factors.append(_factors(own) if n else [])
        return pa.table(
            {
                "doc_id": pa.array([ids[row] for row in block.rows], pa.int64()),
                "n_words": pa.array([len(found_words) for found_words in block.words], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "factors": pa.array(factors, _FACTORS_TYPE),
                "kept": pa.array(kept, pa.string()),
            }
        )

    return run


def remove_shared_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, factors, kept``: the words that stay, joined by one blank.

    ``factors`` are the removed spans, by first word and number of words.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = ids_and_texts(docs, fill=False)
    size = rows.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.sum(F.size(F.split("text", " "))).alias("words")
    ).first()
    tasks = shuffle_partitions(spark)
    # several blocks for each shuffle partition even them out
    blocks = max(4 * tasks, -(-(size["bytes"] or 0) // BLOCK_BYTES))
    parts = max(tasks, -(-(size["words"] or 0) // PART_PHRASES))
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    entries = blocked.groupBy("block").applyInArrow(
        _index_entries(window, parts), "part int, block long, phrases binary, ids binary, counts binary"
    )
    answers = entries.groupBy("part").applyInArrow(_look_up, "block long, part int, found binary")
    return (
        blocked.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _parse(window, parts), f"doc_id long, n_words long, n_removed long, factors {_FACTORS}, kept string"
        )
    )
