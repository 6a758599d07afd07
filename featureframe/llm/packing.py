"""Shortest-pack-first packing of token ids into sequences of bounded length.

Documents longer than a sequence are cut into full pieces and a rest. The packing
itself only sees the histogram of piece lengths: lengths are placed longest first,
each into the pack with the most room, and packs of equal make-up are one pattern with
a count. There are at most three times as many patterns as lengths, whatever the corpus.
Patterns then meet pieces by rank: the k-th piece of a length takes the k-th slot that
patterns have for it. Ranks come from counts by task and length, so no length, however
common, gathers in one task; ids never shuffle.

A null text is empty and has the end id only. Rows that repeat an id are packed as they
come, each for itself. Without rows there are no sequences.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureframe.llm.common import broadcast_file, ids_and_texts
from featureframe.session import new_shared_folder, ship_package

SEQUENCE_LENGTH = 4096


@dataclass
class Pattern:
    """``count`` sequences that each hold ``lengths``, pairs of a length and how often it occurs."""

    lengths: list[tuple[int, int]]
    count: int


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Shortest pack first: the longest length left goes into the pack with the most room."""
    packs: dict[int, list[Pattern]] = {}
    fills: list[int] = []

    def put(fill: int, pattern: Pattern) -> None:
        if fill not in packs:
            packs[fill] = []
            heapq.heappush(fills, fill)
        packs[fill].append(pattern)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and fills and fills[0] + length <= capacity:
            fill = fills[0]
            pattern = packs[fill].pop()
            if not packs[fill]:
                del packs[heapq.heappop(fills)]
            if pattern.count > left:
                put(fill, Pattern(list(pattern.lengths), pattern.count - left))
                pattern.count = left
            left -= pattern.count
            last, times = pattern.lengths[-1]
            if last == length:
                pattern.lengths[-1] = (last, times + 1)
            else:
                pattern.lengths.append((length, 1))
            put(fill + length, pattern)
        # a new pack takes its own length as long as that fits, and only then the next is opened
        fitting = capacity // length
        for times, count in ((fitting, left // fitting), (left % fitting, 1)):
            if times and count:
                put(length * times, Pattern([(length, times)], count))
    return [pattern for fill in sorted(packs, reverse=True) for pattern in packs[fill]]


def slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, sorted by length and first rank.

    Ranks ``rank`` to ``rank + count * times`` of ``length`` fill the sequences
    ``sequence`` to ``sequence + count``, from ``offset`` on.
    """
    rows, used, sequence = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length, times in pattern.lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, pattern.count, offset))
            used[length] = rank + pattern.count * times
            offset += length * times
        sequence += pattern.count
    found = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "count", "offset"), found.T, strict=True))


_PIECES = (
    "doc_id long, start long, length int, doc_tokens long, task int, nth long, ids_crc32 long, ids binary, id_bytes int"
)


def cut_documents(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int, folder: str) -> DataFrame:
    """Pieces of at most ``capacity`` ids, written as Parquet; ``nth`` counts a length's pieces in a task."""
    spark = docs.sparkSession
    ship_package(spark)
    vocabulary = broadcast_file(spark, tokenizer_file)

    def run(batches):
        from featureframe.llm.encoding import text_encoder

        encoder = text_encoder(vocabulary.value)
        width = encoder.dtype.itemsize
        end = np.array([end_id], encoder.dtype).tobytes()
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                rows = []
                part = batch.slice(first, 1024)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = encoder(text.as_py()) + end
                    total = len(ids) // width
                    for start in range(0, total, capacity):
                        piece = ids[start * width : (start + capacity) * width]
                        length = len(piece) // width
                        crc = zlib.crc32(np.frombuffer(piece, encoder.dtype).astype("<u4").tobytes())
                        rows.append((doc_id, start, length, total, task, seen[length], crc, piece, width))
                        seen[length] += 1
                columns = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32()]
                names = ["doc_id", "start", "length", "doc_tokens", "task", "nth", "ids_crc32", "ids", "id_bytes"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(values), kind) for values, kind in zip(columns, kinds, strict=True)], names
                )

    ids_and_texts(docs).mapInArrow(run, _PIECES).write.parquet(folder)
    return spark.read.schema(_PIECES).parquet(folder)


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; all but the ids travel once to learn their rank."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # at most one row for each length up to the capacity
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(pack_histogram(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(firsts, ["length", "task"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids_crc32", "task", "nth", (F.col("first") + F.col("nth")).alias("rank")
    )

    def run(batches):
        known = table.value
        keys = _key(known["length"], known["rank"])
        for batch in batches:
            length, rank = (batch.column(name).to_numpy().astype(np.int64) for name in ("length", "rank"))
            slot = np.searchsorted(keys, _key(length, rank), side="right") - 1
            copy, member = np.divmod(rank - known["rank"][slot], known["count"][slot])
            sequence = pa.array(known["sequence"][slot] + member)
            offset = pa.array(known["offset"][slot] + copy * length)
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, sequence, offset], [*kept.schema.names, "sequence_id", "offset"]
            )

    placed = "doc_id long, start long, length int, doc_tokens long, ids_crc32 long, task int, nth long"
    return ranked.mapInArrow(run, f"{placed}, sequence_id long, offset long")


def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    # ranks stay below 2**48, lengths below 2**15
    return (length << 48) | rank


def pack_documents(
    docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = SEQUENCE_LENGTH
) -> tuple[DataFrame, DataFrame]:
    """``(pieces, placed)``: the pieces with their ids, and where each piece goes.

    ``packed_sequences`` joins the two to padded sequences.
    """
    if not 0 < capacity < 1 << 15:
        raise ValueError("capacity must be between 1 and 32767")
    folder = new_shared_folder(docs.sparkSession, "pieces")
    pieces = cut_documents(docs, tokenizer_file, end_id, capacity, folder)
    return pieces, place(pieces, capacity)


def packed_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id, ids, length``: the ids of each sequence's pieces, in order, as their bytes."""
    joined = placed.join(pieces.select("task", "length", "nth", "ids"), ["task", "length", "nth"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(
        F.array_join(F.transform(parts, lambda part: F.hex(part["ids"])), "").alias("hexed"),
        F.sum("length").cast("int").alias("length"),
    ).select("sequence_id", F.unhex("hexed").alias("ids"), "length")
