"""Token ids in Arrow files of equal-length sequences.

A shard holds the documents of one range of ids, one after another, each with its
end id. ``shard-*.ids.arrow`` is an Arrow IPC file of record batches with two
fixed-size-list columns, ``ids`` and ``mask``: sequence ``k`` of a memory-mapped shard
is a slice of its buffers, nothing is copied or parsed. The last sequence of a shard is
filled up with the end id and masked out there. ``shard-*.docs.arrow`` names where each
document starts in its shard. Ids take two bytes where the vocabulary allows it.

Documents are sorted by id, rows that repeat an id by their text, null ids first. A
null text is empty, so it has the end id only. A shard's file gets its name from the
attempt that writes it and counts once the manifest names it, so a lost or repeated
task leaves at most a file that nobody reads. Tables without rows give no shards.
"""

from __future__ import annotations

import contextlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureframe.llm.common import broadcast_file, ids_and_texts
from featureframe.session import new_shared_folder, settle, ship_package

SEQUENCE_LENGTH = 2048
SEQUENCES_PER_BATCH = 512

_MANIFEST = "shard int, ids_path string, docs_path string, n_docs long, n_ids long"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _SequenceWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, sink, dtype: np.dtype, length: int, end_id: int):
        value = pa.from_numpy_dtype(dtype)
        self._types = pa.list_(value, length), pa.list_(pa.bool_(), length)
        self._file = pa.ipc.new_file(sink, pa.schema([("ids", self._types[0]), ("mask", self._types[1])]))
        self._dtype, self._length, self._end_id = dtype, length, end_id
        self._waiting: list[bytes] = []
        self._bytes = 0
        self._full = SEQUENCES_PER_BATCH * length * dtype.itemsize

    def add(self, ids: bytes) -> None:
        self._waiting.append(ids)
        self._bytes += len(ids)
        if self._bytes >= self._full:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        """Write what is waiting; all batches but a file's last have the same number of sequences."""
        ids = np.frombuffer(b"".join(self._waiting), self._dtype)
        per_batch = SEQUENCES_PER_BATCH * self._length
        given = len(ids)
        if last:
            fill = -given % self._length
            ids = np.concatenate([ids, np.full(fill, self._end_id, self._dtype)])
        whole = len(ids) if last else given // per_batch * per_batch
        for first in range(0, whole, per_batch):
            part = ids[first : min(whole, first + per_batch)]
            mask = np.arange(first, first + len(part)) < given
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(part), self._length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self._length),
            ]
            self._file.write_batch(pa.RecordBatch.from_arrays(columns, ["ids", "mask"]))
        rest = ids[whole:]
        self._waiting = [rest.tobytes()] if len(rest) else []
        self._bytes = len(rest) * self._dtype.itemsize

    def close(self) -> None:
        self._flush(last=True)
        self._file.close()


def write_token_files(
    docs: DataFrame, tokenizer_file: str, end_id: int, folder: str | None = None, length: int = SEQUENCE_LENGTH
) -> DataFrame:
    """Write all texts' ids below ``folder`` (default: a new shared one) and return the manifest.

    The manifest has one row per shard: ``shard, ids_path, docs_path, n_docs, n_ids, start``,
    where ``start`` counts the ids of all shards before.
    """
    spark = docs.sparkSession
    ship_package(spark)
    vocabulary = broadcast_file(spark, tokenizer_file)
    folder = folder or new_shared_folder(spark, "tokens")

    def run(batches):
        from featureframe.llm.encoding import text_encoder

        encoder = text_encoder(vocabulary.value)
        end = np.array([end_id], encoder.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        n_docs = n_ids = 0
        with contextlib.ExitStack() as stack:
            writer = index = None
            for batch in batches:
                if writer is None and batch.num_rows:
                    sink = stack.enter_context(system.open_output_stream(f"{root}/{name}.ids.arrow"))
                    writer = _SequenceWriter(sink, encoder.dtype, length, end_id)
                    index_sink = stack.enter_context(system.open_output_stream(f"{root}/{name}.docs.arrow"))
                    index = stack.enter_context(pa.ipc.new_file(index_sink, _DOCS))
                sizes = []
                for text in batch.column("text"):
                    ids = encoder(text.as_py()) + end
                    writer.add(ids)
                    sizes.append(len(ids) // encoder.dtype.itemsize)
                if sizes:
                    starts = n_ids + np.cumsum([0, *sizes[:-1]])
                    columns = [batch.column("doc_id"), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())]
                    index.write_batch(pa.RecordBatch.from_arrays(columns, schema=_DOCS))
                    n_docs += len(sizes)
                    n_ids += sum(sizes)
            if writer is not None:
                writer.close()
        if n_docs:
            paths = [f"{folder}/{name}.{kind}.arrow" for kind in ("ids", "docs")]
            row = {"shard": [shard], "ids_path": paths[:1], "docs_path": paths[1:], "n_docs": [n_docs], "n_ids": [n_ids]}
            types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(row.values(), types, strict=True)], list(row)
            )

    order = ["doc_id", F.xxhash64("text"), "text"]
    sorted_docs = ids_and_texts(docs).repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    written = settle(sorted_docs.mapInArrow(run, _MANIFEST))
    # one small row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


class TokenShard:
    """Random access to one shard; local files are mapped into memory and not copied."""

    def __init__(self, ids_path: str):
        system, path = _open(ids_path)
        local = isinstance(system, fs.LocalFileSystem)
        self._file = pa.memory_map(path) if local else system.open_input_file(path)
        self._reader = pa.ipc.open_file(self._file)
        self.batches = self._reader.num_record_batches
        self.length = self._reader.schema.field("ids").type.list_size

    def sequences(self, batch: int) -> tuple[np.ndarray, pa.FixedSizeListArray]:
        """Ids (rows of equal length, a view) and masks of one batch."""
        found = self._reader.get_batch(batch)
        ids = found.column("ids").flatten().to_numpy(zero_copy_only=True)
        return ids.reshape(-1, self.length), found.column("mask")

    def sequence(self, number: int) -> np.ndarray:
        return self.sequences(number // SEQUENCES_PER_BATCH)[0][number % SEQUENCES_PER_BATCH]

    def span(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on, across sequences and batches."""
        per_batch = SEQUENCES_PER_BATCH * self.length
        parts = []
        while count > 0:
            batch, at = divmod(start, per_batch)
            part = self.sequences(batch)[0].reshape(-1)[at : at + count]
            if not len(part):
                raise ValueError(f"the shard ends {count} ids before the span does")
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def close(self) -> None:
        self._file.close()


def read_documents(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document as its files have it: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers, ``start`` counts the ids of all
    documents before.
    """
    spark = manifest.sparkSession
    ship_package(spark)

    def read(row: dict) -> Iterator[pa.RecordBatch]:
        system, path = _open(row["docs_path"])
        shard = TokenShard(row["ids_path"])
        with system.open_input_file(path) as file:
            index = pa.ipc.open_file(file)
            for number in range(index.num_record_batches):
                docs = index.get_batch(number)
                for first in range(0, docs.num_rows, 256):
                    part = docs.slice(first, 256)
                    starts, sizes = part.column("start").to_numpy(), part.column("n_tokens")
                    places = zip(starts.tolist(), sizes.to_pylist(), strict=True)
                    ids = [shard.span(start, size).astype("<u4").tobytes() for start, size in places]
                    columns = [part.column("doc_id"), pa.array(starts + row["start"]), sizes]
                    columns.append(pa.array([zlib.crc32(one) for one in ids], pa.int64()))
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array(ids, pa.binary()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
        shard.close()

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from read(row)

    columns = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    shards = spark.sparkContext.defaultParallelism * 4
    return manifest.repartition(shards, "shard").mapInArrow(run, columns)


def read_sequences(manifest: DataFrame) -> DataFrame:
    """Every sequence: ``shard, number, ids array<int>, mask array<boolean>``."""
    ship_package(manifest.sparkSession)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = TokenShard(row["ids_path"])
                for number in range(shard.batches):
                    ids, mask = shard.sequences(number)
                    numbers = np.arange(len(ids)) + number * SEQUENCES_PER_BATCH
                    flat = pa.array(ids.reshape(-1).astype(np.int32))
                    offsets = pa.array(np.arange(len(ids) + 1) * shard.length, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(ids), row["shard"]), pa.int32()),
                            pa.array(numbers, pa.int64()),
                            pa.ListArray.from_arrays(offsets, flat),
                            pa.ListArray.from_arrays(offsets, mask.flatten()),
                        ],
                        ["shard", "number", "ids", "mask"],
                    )

    return manifest.mapInArrow(run, "shard int, number long, ids array<int>, mask array<boolean>")


def stored_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest written as Parquet by ``write_token_files(...).write.parquet(path)``."""
    return spark.read.parquet(path)
