"""Connected components as repeated joins and groupings (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.sources.sinks import stage


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table: two scalars."""
    r = edges.agg(F.count("*"), F.sum((F.xxhash64("a", "b") % 1_000_003).cast("bigint"))).first()
    return r[0], r[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest node of the neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour at or below a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component is the smallest node reachable.

    Rows with a null end and loops carry no link and are left out; repeated edges count once.  Each
    round is two joins on a table of minima that is aggregated before the shuffle, so that a hub of
    any degree is a skewed join side, never one group in a task.  Rounds are cut by written tables.
    """
    now = stage(edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct())
    mark = _mark(now)
    while mark[0]:
        now = stage(_small_star(_large_star(now)))
        if (new := _mark(now)) == mark:
            break
        mark = new
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
