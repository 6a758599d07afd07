"""Byte-level BPE by the tiktoken library and a local rank file.

Long texts are cut first where no match of the splitting pattern can span, so the
pattern never runs over millions of characters at once; runs of white space beyond
that, which such cuts leave whole, go to the merges directly. Decoding gives raw
bytes, which need not be UTF-8 for ids of a part of a text.

Null texts count as empty and have no ids. Ids stay as rows come; each row stands
for itself, so repeated ids and texts need no rule.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from featureframe.llm.common import broadcast_file, chunks, ids_and_texts
from featureframe.session import ship_package

#: Characters the library's pattern gets at once.
SECTION = 20_000
#: Runs of white space from this length on go to the merges directly.
LONG_RUN = 10_000
_RUN = re.compile(r"[\t-\r \x85\xa0  -     　]{%d,}" % LONG_RUN)


class RankEncoder:
    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        self._library = tiktoken.Encoding(
            "local", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}
        )

    def encode(self, text: str) -> list[int]:
        if len(text) <= SECTION:
            return self._library.encode_ordinary(text)
        ids: list[int] = []
        for section in sections(text):
            ids.extend(self._encode_section(section))
        return ids

    def _encode_section(self, section: str) -> list[int]:
        ids: list[int] = []
        start = 0
        for run in _RUN.finditer(section):
            # the pattern gives a run's last character to what follows it
            end = run.end() if run.end() == len(section) else run.end() - 1
            ids.extend(self._library.encode_ordinary(section[start : run.start()]))
            ids.extend(self._library._encode_single_piece(section[run.start() : end]))
            start = end
        return ids + self._library.encode_ordinary(section[start:])

    def decode(self, ids: list[int]) -> bytes:
        return self._library.decode_bytes(ids)


def sections(text: str) -> Iterator[str]:
    """``text`` in pieces of about ``SECTION`` characters, longer only where there is no safe cut."""
    gathered: list[str] = []
    size = 0
    for chunk in chunks(text):
        if size + len(chunk) > SECTION and gathered:
            yield "".join(gathered)
            gathered, size = [], 0
        gathered.append(chunk)
        size += len(chunk)
    yield "".join(gathered)


def _encoder(ranks: Broadcast, pattern: str) -> RankEncoder:
    return RankEncoder(ranks.value, pattern)


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids``, the text's token ids as little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    ship_package(spark)
    ranks = broadcast_file(spark, rank_file)

    def run(batches):
        encoder = _encoder(ranks, pattern)
        for batch in batches:
            ids = [np.array(encoder.encode(text.as_py()), "<u4").tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with ``decoded``, the raw bytes of its ids; null for null ids."""
    spark = encoded.sparkSession
    ship_package(spark)
    ranks = broadcast_file(spark, rank_file)

    def run(batches):
        encoder = _encoder(ranks, pattern)
        for batch in batches:
            raw = [
                None if (ids := value.as_py()) is None else encoder.decode(np.frombuffer(ids, "<u4").tolist())
                for value in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(raw, pa.binary())], ["doc_id", "ids", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
