"""Connected components of an edge table by alternating large and small stars.

Each round links every node to the smallest node it sees; the number of rounds grows
with the logarithm of the longest path.  Only aggregates (combined before the
shuffle) and equi-joins are used, so a node with very many edges is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import discard, stored


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each first node, itself included."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it reaches.

    Loops, repeated and reversed edges are allowed; an empty table has no nodes.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    summary = None
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.join(_least(large), "a")
        last, current = current, stored(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            "edges",
        )
        discard(last)
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == summary:
            break
        summary = seen
    # Now every edge goes from a node to its component's smallest node.
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select("component", "component").toDF("node", "component").distinct())
