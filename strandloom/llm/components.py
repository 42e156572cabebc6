"""Connected components of a table of links by alternating stars, on Spark tables throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _done(edges: DataFrame) -> bool:
    """Whether edges (u, v), u > v, are stars: each u has one v, and no v is a u."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def _toward_least(sides: DataFrame, with_self: bool) -> DataFrame:
    """sides (u, v): each v of u goes to the least among u's v (and u itself)."""
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    if with_self:
        least = least.select("u", F.least("u", "m").alias("m"))
    return sides.join(least, "u")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node with a link to another, the least node that it reaches.

    Links may repeat and stand in any order; loops and null ends are left out. Every round is a join and a group-by
    written as a table; their number grows with the logarithm of the longest path.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = stored(edges.distinct(), "links")
    while not _done(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both, True).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        joined = _toward_least(large, False)
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))).distinct()
        after = stored(small, "stars")
        discard(edges)
        edges = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
