"""Connected components of a graph given as edges, by repeated star contraction.

Both steps are a minimum per node and a join back; minima combine before their shuffle, and the join
is between written tables, so adaptive execution can split a node with very many edges. Every round is
written to the shared folder, which also cuts the lineage. Nothing but two numbers per step is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import stage


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u long, v long) to (node, component): the smallest node that can be reached.

    Nodes without edges have no row. Loops and repeated edges do no harm; null ends are left out.
    """
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    current = edges.where("u <> v").select(high, low).distinct()
    current = stage(current, "edges")
    seen = None
    while True:
        current = _small_star(_large_star(current))
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stage(stars.union(roots).distinct(), "components")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least")), "least")
    # An edge is taken from its smaller end, so the larger neighbours are its ``u``.
    moved = edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("least").alias("v"))
    return stage(moved.where("u <> v").distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("least")), "least")
    neighbours = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    moved = neighbours.union(least.select("u", F.col("least").alias("v")))
    return stage(moved.where("u <> v").distinct(), "small-star")
