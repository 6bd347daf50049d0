"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, keep: Callable[[DataFrame], DataFrame], *, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of an edge, component being the smallest node reachable.

    Alternating stars: neighbours of a node are hung on the smallest one, until each hangs on a node that hangs on none.
    The number of edges never grows, and each round is two aggregations and two joins, however many neighbours a node
    has; a hub's rows are many in the joins, which adaptive execution splits. `keep` stores a step and gives it back (a
    written table, for instance), which cuts the lineage of the loop. Edges with a null end and loops are dropped.
    """
    a, b = F.col("a"), F.col("b")
    pairs = edges.select(F.col(src).alias("x"), F.col(dst).alias("y")).filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    pairs = keep(pairs.distinct())
    while not _stars(pairs):
        both = pairs.select("a", "b").unionByName(pairs.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b")).union(pairs.join(least, "a").select("a", F.col("m").alias("b")))
        large = keep(large.filter(a != b).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(b.alias("a"), F.col("m").alias("b")).filter(a != b)
        pairs = keep(small.union(least.select("a", F.col("m").alias("b"))).distinct())
    return pairs.select(a.alias("node"), b.alias("component")).union(pairs.select(b, b).distinct())


def _stars(pairs: DataFrame) -> bool:
    """Each node hangs on one other at most, and none on a node that hangs on another itself."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(pairs.select("b", F.lit(0), F.lit(1)))
    own = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return own.filter("up > 1 or (up = 1 and down = 1)").isEmpty()
