"""Connected components of a graph given as edges between numbers.

Every round points the neighbours of each node at the smallest of them, first the larger ones, then the smaller ones, until nothing
moves; paths of any length shrink to stars in a logarithmic number of rounds. A round is two pairs of a grouping with
partial minima and a join against one row per node, and ends in a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _toward_least(arcs: DataFrame, keep_self: bool) -> DataFrame:
    """(high, low) of arcs (node, near) that lead from each near node to the least node around ``node``."""
    least = arcs.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("least"))
    moved = arcs.join(least, "node").select(F.col("near").alias("high"), F.col("least").alias("low"))
    if keep_self:
        moved = moved.union(least.select("node", "least"))
    return moved.filter("high > low").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of edges (a, b): the smallest node of each component, for nodes that have an edge to another one."""
    stars = cut_lineage(edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).filter("high > low").distinct())
    before = None
    while True:
        both = stars.select(F.col("high").alias("node"), F.col("low").alias("near")).union(stars.select("low", "high"))
        larger = both.groupBy("node").agg(F.min("near").alias("near"))
        larger = larger.select("node", F.least("node", "near").alias("least"))
        up = both.filter("near > node").join(larger, "node").select(F.col("near").alias("high"), F.col("least").alias("low"))
        up = cut_lineage(up.filter("high > low").distinct())
        stars = cut_lineage(_toward_least(up.select(F.col("high").alias("node"), F.col("low").alias("near")), True))
        after = stars.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return stars.select(F.col("high").alias("node"), F.col("low").alias("component")).union(stars.select("low", "low").distinct())
