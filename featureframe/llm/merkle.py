"""A manifest that proves which rows a data set holds: Merkle trees over all of them.

Every row is a leaf, the hash of its fields. The leaves of a source, by id, are hashed in
runs of ``FAN`` until one hash, the source's subroot, is left; the subroots, by source, are
hashed the same way to the root. With a row's siblings on the way up anybody can recompute
the root from that row alone.

Leaves get their place in the source by a sort over ranges of (source, id) and the counts
of these ranges, so a source is not tied to a task. ``FAN ** DEPTH`` consecutive leaves are
an aligned block. A block keeps each of its levels as a list of digests: parents are the
hashes of runs of ``FAN`` of them, and the siblings of a node are those to the left and
right of it in its run. They are reached by place, so what a row costs grows with the levels
and not with the rows of its block. The roots of the
blocks are the nodes of the next round, until every source has one block; then the roots of
the sources are. Blocks meet what is above them one to one, however large their source.

H is sha256 in lower-case hex of its concatenated inputs. A field is ``-`` if null, else
the number of its UTF-8 bytes, a colon, and its value. Null ids come before all others, as
does the null source. Rows that repeat an id follow each other by their leaf, and have each
a place and a proof of their own. A tree of one row has that leaf as its root and H of
nothing as its proof. Tables without rows give none, and no root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureframe.llm.common import shuffle_partitions
from featureframe.session import new_shared_folder

#: Fixed value: the fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Fixed value: nodes hashed together.
FAN = 3
#: Levels of a block: 2,187 leaves, with 140 kB of digests in the lowest level.
DEPTH = 7

_PATH = "array<struct<left:string,right:string>>"


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf(columns: dict[str, Column] | None = None) -> Column:
    """The leaf of a row; ``columns`` stand in for those of the same name."""
    own = columns or {}
    return _hash(F.concat(*(_field(own.get(name, F.col(name))) for name in FIELDS)))


def _kept(df: DataFrame, label: str) -> DataFrame:
    folder = new_shared_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _same(one: str, other: str) -> Column:
    return F.col(one).eqNullSafe(F.col(other))


def _indexed(rows: DataFrame) -> DataFrame:
    """``rows`` (``tree, order, digest, held``) with ``at``, the place in their tree by ``order`` and digest, from 0."""
    spark = rows.sparkSession
    by = [F.asc_nulls_first("tree"), F.asc_nulls_first("order"), F.asc("digest")]
    dealt = rows.repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by)
    # the number holds the partition in its upper bits and the row's place there in the lower 33
    dealt = _kept(dealt.withColumn("number", F.monotonically_increasing_id()), "sorted").withColumn("range", F.shiftright("number", 33))
    first = dealt.groupBy("tree", "range").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = first.select(
        F.col("tree").alias("of"), F.col("range").alias("of_range"), "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    placed = dealt.join(first, _same("tree", "of") & (F.col("range") == F.col("of_range")))
    return placed.select("tree", "digest", "held", (F.col("before") + F.col("number") - F.col("first")).alias("at"))


def _parents(level: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(level) - 1, F.lit(FAN))
    # places past the end give null, which the text of a run leaves out
    return F.transform(starts, lambda start: _hash(F.concat_ws("", *(F.get(level, start + n) for n in range(FAN)))))


def _blocks(nodes: DataFrame) -> DataFrame:
    """``tree, block, nodes, levels``; ``levels`` are lists of digests, the block's root alone in the last."""
    size = FAN**DEPTH
    whole = nodes.groupBy("tree").agg(F.max("at").alias("last")).select(F.col("tree").alias("of"), (F.col("last") >= size).alias("parted"))
    # all nodes of a block have one row, and a tree has one row for each of its blocks
    found = nodes.groupBy("tree", F.floor(F.col("at") / size).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("at", "digest", "held"))).alias("nodes")
    )
    found = found.join(whole, _same("tree", "of"))
    lowest = F.col("nodes.digest")
    # while a tree has several blocks, each goes up by all levels; a lone block ends at one node
    higher = lambda levels, top: F.when(
        F.col("parted") | (F.size(top) > 1), F.concat(levels, F.array(_parents(top)))
    ).otherwise(levels)
    levels = F.aggregate(
        F.sequence(F.lit(1), F.lit(DEPTH)), F.array(lowest), lambda levels, _: higher(levels, F.element_at(levels, -1))
    )
    return found.select("tree", "block", "nodes", levels.alias("levels"))


def _siblings(levels: Column, at: Column) -> Column:
    """What stands beside node ``at`` of the lowest level, and beside its ancestors in the block."""
    powers = F.array(*(F.lit(FAN**level) for level in range(DEPTH)))

    def beside(level: Column, n: Column) -> Column:
        node = F.floor(at / powers[n]).cast("int")
        place = node % FAN
        # places past the end give null, as do those on the other side
        left = (F.when(place >= n, F.get(level, node - n)) for n in range(FAN - 1, 0, -1))
        right = (F.when(place + n < FAN, F.get(level, node + n)) for n in range(1, FAN))
        return F.struct(F.concat_ws("", *left).alias("left"), F.concat_ws("", *right).alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), beside)


def _climbed(nodes: DataFrame, above_trees: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``tree, at, digest, held, path, subroot, root`` of every node.

    ``above_trees`` takes ``tree, subroot`` and gives ``tree, path, root``.
    """
    blocks = _kept(_blocks(nodes), "blocks")
    tops = blocks.select("tree", F.col("block").alias("at"), F.element_at(F.element_at("levels", -1), 1).alias("digest"))
    if blocks.filter("block > 0").isEmpty():
        trees = tops.select("tree", F.col("digest").alias("subroot"))
        ends = above_trees(trees).withColumnRenamed("tree", "of")
        above = trees.join(ends, _same("tree", "of")).select(F.col("tree").alias("of"), F.lit(0).alias("of_block"), "path", "subroot", "root")
    else:
        above = _climbed(tops.withColumn("held", F.lit(None).cast("struct<none:int>")), above_trees)
        above = above.select(F.col("tree").alias("of"), F.col("at").alias("of_block"), "path", "subroot", "root")
    met = blocks.join(above, _same("tree", "of") & (F.col("block") == F.col("of_block")))
    whole_path = lambda node: F.concat(_siblings(F.col("levels"), (node["at"] % FAN**DEPTH).cast("int")), F.col("path"))
    paths = F.transform(
        "nodes", lambda node: F.struct(node["at"].alias("at"), node["digest"].alias("digest"), node["held"].alias("held"), whole_path(node).alias("path"))
    )
    return met.select("tree", "subroot", "root", F.inline(paths))


def _top(subroots: DataFrame) -> DataFrame:
    """The tree over all sources."""
    rows = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("order"), F.col("subroot").alias("digest"), F.struct(F.col("tree").alias("source")).alias("held"))
    alone = lambda trees: trees.select("tree", F.array().cast(_PATH).alias("path"), F.col("subroot").alias("root"))
    return _climbed(_indexed(rows), alone).select(F.col("held.source").alias("tree"), "path", "root")


def manifest(docs: DataFrame, **held: Column) -> DataFrame:
    """One row per row of ``docs``: ``source, at, doc_id, leaf, path, subroot, root``, and ``held`` columns.

    ``at`` is the place in the source. ``path`` has, level by level from leaf to root, the
    digests to the left and right of the row's ancestor in its run, as hex text.
    """
    source = F.col("source").cast("string")
    columns = F.struct(F.col("doc_id").alias("doc_id"), *(value.alias(name) for name, value in held.items()))
    rows = docs.select(source.alias("tree"), F.col("doc_id").alias("order"), leaf().alias("digest"), columns.alias("held"))
    # kept, as the sort reads its input twice and leaves are dear
    found = _climbed(_indexed(_kept(rows, "leaves")), _top)
    own = [F.col("held")[name].alias(name) for name in held]
    return found.select(F.col("tree").alias("source"), "at", F.col("held.doc_id").alias("doc_id"), F.col("digest").alias("leaf"), "path", "subroot", "root", *own)


def proof(path: Column) -> Column:
    """All siblings of a row as text, from leaf to root and from left to right."""
    return F.array_join(F.transform(path, lambda beside: F.concat(beside["left"], beside["right"])), "")


def folded(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf_digest, lambda node, beside: _hash(F.concat(beside["left"], node, beside["right"])))
