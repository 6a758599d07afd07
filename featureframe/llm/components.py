"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureframe.session import settle


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the node's smallest neighbour or itself."""
    both = links.select("u", "v").union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the smallest of them; ``u > v`` in all links."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    moved = links.join(least, "u").filter("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` of all linked nodes; a component is named by its smallest node.

    ``links`` has two long columns in any order and direction; repeated links and links
    of a node to itself change nothing. Nodes without a link to another are left out.
    The number of rounds grows with the logarithm of the longest path.
    """
    a, b = (F.col(name) for name in links.columns[:2])
    links = links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = settle(links)
    state = _state(links)
    while True:
        links = settle(_small_star(_large_star(links)))
        after = _state(links)
        if after == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = after
