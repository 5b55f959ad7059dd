"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a minimum per node (combined before the shuffle) joined back to the edges, so a
node with very many edges is split like any skewed join key; no neighbour list is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logfreight.session import written_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step. ``edges`` has u > v. Large: neighbours above a node go to its least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    met = both.join(least, "u")
    if large:
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def _is_settled(current: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none to a lesser one."""
    lesser = current.groupBy("u").agg(F.count("*").alias("n"))
    if lesser.filter("n > 1").limit(1).count():
        return False
    return not current.select(F.col("v").alias("u")).distinct().join(lesser, "u", "left_semi").limit(1).count()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, component (the least node) for every node that has an edge (columns a, b)."""
    made = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = written_table(made.filter("u > v").distinct())
    for _ in range(rounds):
        if _is_settled(current):
            break
        current = written_table(_star(_star(current, large=True), large=False))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
