"""Connected components of an edge table, by rounds of large and small stars.

Each round points the larger neighbours of every node at its smallest one, then the smaller ones and the node
itself; stars merge until nothing changes, in a logarithmic number of rounds. A round is two groupings with partial
minima and two joins against a side with one row per node; it ends in a stored table, so a lost executor costs no more than a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), v the smaller end."""
    both = edges.union(edges.select("v", "u")) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        least = least.select("u", F.least("u", "m").alias("m"))
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (a, b): the smallest node of each component, itself included."""
    edges = cut_lineage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    )
    seen = None
    while True:
        edges = cut_lineage(_star(_star(edges, True), False))
        # A changed edge set has another number of rows or another sum of hashes.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(edges.select("v", "v").distinct()).distinct()
