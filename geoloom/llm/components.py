"""Connected components of an edge table by alternating large and small stars.

Every round runs two joins on the node id; no component, link list or node set
comes to the driver.  Each round's edges are cut with a checkpoint, so a lost
executor repeats one round at most.  The hub of a star can have very many
edges; those joins are plain sort-merge joins, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the node's smallest neighbour (or the node itself)."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return near.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a != b")


def _small(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are linked to the smallest of these; edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    own = least.select(F.col("m").alias("a"), "b")
    rest = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a != b")
    return own.union(rest)


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node on an edge (a, b)."""
    now = cut(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)), F.coalesce(F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        now = cut(_small(_large(now).distinct()).distinct())
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
