"""Near duplicates by b-bit MinHash, confirmed on full shingle sets.

1. Every document's shingle set gets ``bands * rows`` minima. Their low bits are packed
   into a signature; the minima of a band hashed together are the band's key. Documents of
   the same set are one node, named by their smallest id.
2. In each band key the node with the smallest id is the centre, and each other node is
   paired with it: as many pairs as members, never all pairs of a key. Agreeing low bits,
   corrected for chance agreement, estimate the similarity of a pair.
3. Each node is confirmed against its likeliest centre, and confirmed links are joined to
   components.
4. Nodes that share a key share its centre. So what is left are pairs of different
   components with a common centre. Members of a centre are dealt into chunks of bounded
   size, and chunks meet in pairs, but for pairs of chunks whose members are all in the
   centre's component. Inside a pair of chunks estimates come from bit counts of whole
   signatures, and pairs that may reach the threshold are confirmed unless already joined.

So every pair that shares a band key is either confirmed or not needed: no link is lost
there, none is cut off by a cap. A pair at the threshold shares no key with probability
(1 - s**rows)**bands, 3e-6 for the defaults, and its estimate misses ``margin`` with 3e-7.

Links hold where 100 * intersection >= 100 * similarity * union, on 64-bit hashes of the
shingles. Texts without words (null ones too) are linked with nothing and their own
component. Rows that repeat an id are judged by their own texts. Rows with a null id are
told their shingles, but neither link nor are dropped: their component is null.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureframe.llm.common import SLOT_BITS, ids_and_texts, in_slot_map, slot_map
from featureframe.llm.components import connected_components
from featureframe.llm.shingles import MinHash, set_key, shingle_set
from featureframe.session import new_shared_folder, settle, ship_package

BANDS, ROWS, BITS = 42, 6, 2
#: Members of a chunk; two chunks meet at a time.
CHUNK = 128


def _written(df: DataFrame, label: str) -> DataFrame:
    """Kept as a table in the shared folder, from where columns are read apart."""
    folder = new_shared_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _signatures(docs: DataFrame, width: int, hasher: MinHash) -> DataFrame:
    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                sets = [shingle_set(text.as_py(), width) for text in part.column("text")]
                keys = [set_key(one) if len(one) else None for one in sets]
                # equal sets of the part are hashed once
                own = {key: one for key, one in zip(keys, sets, strict=True) if key is not None}
                at = {key: number for number, key in enumerate(own)}
                minima = hasher(list(own.values())) if own else np.zeros((0, hasher.minima), np.uint32)
                bands, packed = hasher.band_keys(minima), hasher.packed(minima)
                row = [at.get(key) for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(one) for one in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array([None if k is None else bands[k] for k in row], pa.list_(pa.int64())),
                        pa.array([None if k is None else packed[k] for k in row], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "key", "bands", "signature"],
                )

    return docs.mapInArrow(
        run, "doc_id long, n_shingles long, key binary, bands array<long>, signature array<long>"
    )


def _estimate(hasher: MinHash, one: Column, other: Column) -> Column:
    """Similarity from agreeing low bits, corrected for agreement by chance."""
    counts = []
    for word in range(hasher.minima * hasher.bits // 64):
        differing = one[word].bitwiseXOR(other[word])
        for shift in range(1, hasher.bits):
            differing = differing.bitwiseOR(F.shiftrightunsigned(one[word].bitwiseXOR(other[word]), shift))
        counts.append(F.bit_count(differing.bitwiseAND(F.lit(_low_bits(hasher.bits)))))
    agreeing = 1 - reduce(add, counts) / hasher.minima
    chance = 2.0**-hasher.bits
    return (agreeing - chance) / (1 - chance)


def _low_bits(bits: int) -> int:
    mask = sum(1 << at for at in range(0, 64, bits))
    return mask - (1 << 64) if mask >> 63 else mask


def _reaches(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(other) - common)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets reach the threshold."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("other"))

    def run(batches):
        for batch in batches:
            kept = [
                _reaches(np.frombuffer(one.as_py(), np.uint64), np.frombuffer(other.as_py(), np.uint64), percent)
                for one, other in zip(batch.column("one"), batch.column("other"), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "one", "other").mapInArrow(
        run, "a long, b long"
    )


def _likely(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The documents of ``nodes``, and by chance some others: texts of the rest need not be shuffled."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << SLOT_BITS)).alias("slot")
    wanted = docs.sparkSession.sparkContext.broadcast(slot_map(nodes.select(F.col("node").alias("doc_id")).select(slot)))

    def run(batches):
        for batch in batches:
            kept = in_slot_map(wanted.value, batch.column("slot").to_numpy())
            yield batch.select(["doc_id", "text"]).filter(pa.array(kept))

    return docs.select("doc_id", "text", slot).mapInArrow(run, "doc_id long, text string")


def _sets_of(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node, shingles, signature`` of ``nodes`` (``node``, ``key``, ``signature``)."""
    found = _likely(docs, nodes).join(nodes.withColumnRenamed("node", "doc_id"), "doc_id")

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                sets = [shingle_set(text.as_py(), width) for text in part.column("text")]
                # rows that repeat an id may have another text
                own = [set_key(one) == key.as_py() for one, key in zip(sets, part.column("key"), strict=True)]
                shingles = pa.array([one.tobytes() for one in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), shingles, part.column("signature")], ["node", "shingles", "signature"]
                ).filter(pa.array(own, pa.bool_()))

    return found.select("doc_id", "text", "key", "signature").mapInArrow(
        run, "node long, shingles binary, signature array<long>"
    )


def _members(column: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    rows = column.values
    sets = [np.frombuffer(one.as_py(), np.uint64) for one in rows.field("shingles")]
    signature = np.array(rows.field("signature").to_pylist(), np.int64).reshape(len(sets), -1)
    node, component = (rows.field(name).to_numpy() for name in ("node", "component"))
    return node, component, np.array([len(one) for one in sets]), signature, sets


def _links_between(hasher: MinHash, percent: int, least: float):
    mask = np.int64(_low_bits(hasher.bits))
    chance = 2.0**-hasher.bits

    def pair(one, other, same: bool) -> list[tuple[int, int]]:
        node, component, size, signature, sets = one
        node2, component2, size2, signature2, sets2 = other
        agreeing = np.zeros((len(node), len(node2)))
        for word in range(signature.shape[1]):
            differing = signature[:, word, None] ^ signature2[None, :, word]
            merged = differing.copy()
            for shift in range(1, hasher.bits):
                merged |= differing >> np.int64(shift)
            agreeing += np.bitwise_count((merged & mask).view(np.uint64))
        estimate = (1 - agreeing / hasher.minima - chance) / (1 - chance)
        may = (estimate >= least) & (component[:, None] != component2[None, :])
        may &= 100 * np.minimum(size[:, None], size2) >= percent * np.maximum(size[:, None], size2)
        if same:
            may = np.triu(may, 1)
        rows, columns = np.nonzero(may)
        joined: dict[int, int] = {}

        def root(name: int) -> int:
            while (above := joined.get(name, name)) != name:
                name = above
            return name

        links = []
        for at in np.argsort(-estimate[rows, columns], kind="stable"):
            row, column = rows[at], columns[at]
            left, right = root(int(component[row])), root(int(component2[column]))
            if left != right and _reaches(sets[row], sets2[column], percent):
                joined[left] = right
                links.append((int(node[row]), int(node2[column])))
        return links

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = _members(batch.column("one")[row])
                same = batch.column("same")[row].as_py()
                links = pair(one, one if same else _members(batch.column("other")[row]), same)
                if links:
                    a, b = zip(*links, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _remaining_links(
    stars: DataFrame, components: DataFrame, sets: DataFrame, hasher: MinHash, percent: int, least: float
) -> DataFrame:
    """Links between different components among the members of each centre."""
    own = stars.select("centre", "node").union(stars.select("centre", F.col("centre").alias("node")).distinct())
    named = own.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    at_centre = named.filter("node = centre").select("centre", F.col("component").alias("main"))
    named = named.join(at_centre, "centre").withColumn("apart", F.col("component") != F.col("main"))
    sizes = named.groupBy("centre").agg(
        F.count_if("apart").alias("n_apart"), F.count_if(~F.col("apart")).alias("n_main")
    )
    dealt = named.join(sizes.filter("n_apart > 0"), "centre").withColumn(
        "chunk",
        F.pmod(F.xxhash64("node"), F.ceil(F.when(F.col("apart"), F.col("n_apart")).otherwise(F.col("n_main")) / CHUNK)),
    )
    chunks = (
        dealt.join(sets, "node")
        .groupBy("centre", "apart", "chunk")
        .agg(F.collect_list(F.struct("node", "component", "shingles", "signature")).alias("members"))
        .withColumn("order", F.struct(~F.col("apart"), "chunk"))
    )
    chunks = _written(chunks.select("centre", "apart", "order", "members"), "chunks")
    other = chunks.select("centre", F.col("order").alias("order2"), F.col("members").alias("other"))
    # chunks of the centre's own component come last, and meet only those before them
    pairs = chunks.filter("apart").join(other, "centre").filter("order <= order2")
    same = F.col("order") == F.col("order2")
    pairs = pairs.select(
        same.alias("same"), F.col("members").alias("one"), F.when(~same, F.col("other")).alias("other")
    )
    return pairs.mapInArrow(_links_between(hasher, percent, least), "a long, b long")


def find_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, margin: float = 0.155) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    ``width`` words make a shingle; texts link at ``percent`` similarity. ``margin`` is how
    far an estimate may fall short of that before a pair is left out, five deviations for
    the number of minima used.
    """
    ship_package(docs.sparkSession)
    hasher = MinHash(BANDS, ROWS, BITS)
    least = percent / 100 - margin
    texts = ids_and_texts(docs, fill=False)
    signed = _written(_signatures(texts, width, hasher), "signatures")
    nodes = _written(
        signed.filter("key is not null and doc_id is not null")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
        ),
        "nodes",
    )
    banded = nodes.select("node", F.explode("bands").alias("band"))
    centres = banded.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("n")).filter("n > 1")
    stars = settle(banded.join(centres, "band").filter("node != centre").select("node", "centre").distinct())
    involved = stars.select("node").union(stars.select(F.col("centre"))).distinct()
    involved = nodes.join(involved, "node").select("node", "key", "signature")
    sets = _written(_sets_of(texts, involved, width), "sets")
    one = sets.select("node", F.col("signature").alias("one"))
    other = sets.select(F.col("node").alias("centre"), F.col("signature").alias("other"))
    likeliest = (
        stars.join(one, "node")
        .join(other, "centre")
        .select("node", "centre", _estimate(hasher, F.col("one"), F.col("other")).alias("estimate"))
        .filter(F.col("estimate") >= least)
        .groupBy("node")
        .agg(F.max_by("centre", F.struct("estimate", F.bitwise_not("centre"))).alias("centre"))
        .select(F.col("node").alias("a"), F.col("centre").alias("b"))
    )
    links = settle(_confirm(likeliest, sets, percent))
    components = settle(connected_components(links))
    more = settle(_remaining_links(stars, components, sets, hasher, percent, least))
    if not more.isEmpty():
        components = settle(connected_components(links.union(more)))
    named = nodes.select("key", "node").join(components, "node", "left")
    named = named.select("key", F.coalesce("component", "node").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        signed.select("doc_id", "n_shingles", "key")
        .join(named, "key", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component its smallest id.

    Of rows that repeat an id all stay or none, so nothing unique is lost.
    """
    judged = find_near_duplicates(docs, width, percent).filter("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(judged.distinct(), docs["doc_id"].cast("long").eqNullSafe(F.col("kept_id")), "left_semi")
