"""Nearest vectors by inner product: a block matrix join on int8 tiles with error bounds.

Queries and candidates are dealt into blocks by a hash of their id. Every query block
meets every candidate block of its dimension. In a tile, vectors are rounded to int8
with a scale of their own, and one matrix product gives all inner products of the rounded
vectors. The rounding errors are known, so by Cauchy-Schwarz

    |q.c - q'.c'| <= |q - q'| |c| + |q'| |c - c'|

A candidate stays while its upper bound reaches the k-th largest lower bound of its tile,
so none of the k nearest is ever left out. What stays is computed in double precision, and
the lists of all tiles are merged by a heap of k entries per query.

Vectors that are null, empty or zero, or hold null or non-finite components, take no part,
nor do rows without an id. Vectors of different dimensions are not compared. Of rows that
repeat an id, the smallest vector counts. Ties go to the smaller id. A query with fewer
candidates gets all of them, one without any no row.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureframe.llm.common import shuffle_partitions
from featureframe.session import settle, ship_package

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
#: Query rows of a tile whose bounds are held at a time.
STRIP = 128


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _pack(table: pa.Table) -> pa.Table:
    """One block of vectors as one row, sorted by id."""
    ids = table.column("id").to_numpy()
    vectors = np.array(table.column("vector").to_pylist(), np.float64).reshape(len(ids), -1)
    order = np.lexsort((*vectors.T[::-1], ids))
    order = order[np.concatenate([[True], np.diff(ids[order]) != 0])]
    return pa.table(
        {
            "dim": table.column("dim").slice(0, 1),
            "block": table.column("block").slice(0, 1),
            "ids": pa.array([ids[order].tobytes()], pa.binary()),
            "vectors": pa.array([vectors[order].tobytes()], pa.binary()),
        }
    )


def _blocks(rows: DataFrame, size: int, least: int) -> DataFrame:
    """``dim, block, ids, vectors``: rows dealt into blocks of about ``size``, at least ``least`` of them."""
    n = rows.count()
    blocks = max(least, -(-n // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("dim", "block").applyInArrow(_pack, "dim int, block int, ids binary, vectors binary")


class _Rounded:
    """Vectors as multiples of int8 numbers, with the norms the error bound needs."""

    def __init__(self, ids: bytes, vectors: bytes, dim: int):
        self.ids = np.frombuffer(ids, np.int64)
        self.exact = np.frombuffer(vectors, np.float64).reshape(-1, dim)
        self.scale = np.abs(self.exact).max(axis=1) / 127
        with np.errstate(divide="ignore", invalid="ignore"):
            whole = np.rint(self.exact / self.scale[:, None])
        # a scale that underflows leaves nothing to round to: the whole vector is error then
        self.whole = np.where(np.isfinite(whole), np.clip(whole, -127, 127), 0).astype(np.int8)
        rounded = self.whole * self.scale[:, None]
        self.norm = np.linalg.norm(self.exact, axis=1)
        self.rounded_norm = np.linalg.norm(rounded, axis=1)
        self.error = np.linalg.norm(self.exact - rounded, axis=1)


def _products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows; single precision holds whole numbers up to 2**24."""
    kind = np.float32 if one.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return (one.astype(kind) @ other.astype(kind).T).astype(np.float64)


def _inner(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row, summed in the order of the components."""
    total = np.zeros(len(one))
    for component in range(one.shape[1]):
        total += one[:, component] * other[:, component]
    return total


def _tile(queries: _Rounded, candidates: _Rounded, k: int):
    """``(query id, vector id, score)`` arrays of each query's ``k`` nearest of the tile."""
    for first in range(0, len(queries.ids), STRIP):
        strip = slice(first, first + STRIP)
        near = _products(queries.whole[strip], candidates.whole)
        near *= queries.scale[strip, None]
        near *= candidates.scale
        error = np.outer(queries.error[strip], candidates.norm)
        error += np.outer(queries.rounded_norm[strip], candidates.error)
        # what double precision itself may lose
        error += 1e-12 * np.outer(queries.norm[strip], candidates.norm)
        own = queries.ids[strip, None] == candidates.ids
        lower = np.where(own, -np.inf, near - error)
        place = lower.shape[1] - k
        least = np.partition(lower, place, axis=1)[:, place] if place > 0 else np.full(len(lower), -np.inf)
        query, candidate = np.nonzero((near + error >= least[:, None]) & ~own)
        score = _inner(queries.exact[strip][query], candidates.exact[candidate])
        order = np.lexsort((candidates.ids[candidate], -score, query))
        query, candidate, score = query[order], candidate[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < k
        yield queries.ids[strip][query[kept]], candidates.ids[candidate[kept]], score[kept]


def _search_tiles(k: int):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                dim, ids, vectors, query_ids, query_vectors = (batch.column(at)[row].as_py() for at in range(5))
                queries, candidates = _Rounded(query_ids, query_vectors, dim), _Rounded(ids, vectors, dim)
                for query, vec, score in _tile(queries, candidates, k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"]
                    )

    return run


def _merge(k: int):
    """Queries come one after another; a heap holds the best ``k`` of the current one."""

    def run(batches):
        current, heap, done = None, [], []

        def close():
            ranked = sorted(heap, reverse=True)
            done.extend((current, rank, -minus_id, score) for rank, (score, minus_id) in enumerate(ranked, 1))

        def flush():
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
            columns = [pa.array(list(values), kind) for values, kind in zip(zip(*done, strict=True), kinds, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("query_id", "vec_id", "score"))
            for query, vec, score in zip(*columns, strict=True):
                if query != current:
                    close()
                    current, heap = query, []
                entry = (score, -vec)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
            if done:
                yield flush()
        close()
        if done:
            yield flush()

    return run


def nearest(vectors: DataFrame, queries: Column, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest other rows of each row where ``queries`` holds.

    ``vectors`` has ``vec_id`` and ``embedding``; scores are inner products in double precision.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    picked = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        queries.alias("is_query"),
    )
    rows = picked.filter(F.col("id").isNotNull() & _usable(F.col("vector"))).withColumn("dim", F.size("vector"))
    candidates = settle(_blocks(rows.select("id", "vector", "dim"), CANDIDATE_BLOCK, 2 * spark.sparkContext.defaultParallelism))
    asked = _blocks(rows.filter("is_query").select("id", "vector", "dim"), QUERY_BLOCK, 1)
    asked = asked.select(
        "dim", F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors")
    )
    # each query block is sent to each candidate block of its dimension
    numbers = candidates.select("dim", "block")
    sent = asked.join(numbers, "dim")
    tiles = candidates.join(sent, ["dim", "block"]).select("dim", "ids", "vectors", "query_ids", "query_vectors")
    tiles = tiles.repartition(max(shuffle_partitions(spark), 2 * spark.sparkContext.defaultParallelism))
    found = tiles.mapInArrow(_search_tiles(k), "query_id long, vec_id long, score double")
    dealt = found.repartition("query_id").sortWithinPartitions("query_id")
    return dealt.mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")
