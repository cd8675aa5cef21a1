"""Connected components of a graph of 64-bit nodes, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import durable


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b``: long); nodes share a root if they are connected.

    Nodes are renamed by a one-to-one hash, so that the smallest neighbour is a random one and the number of rounds
    stays logarithmic whatever the shape of the graph. Each round gives every node the smallest of its neighbours
    and itself as parent (a minimum, combined before the shuffle), replaces the ends of the edges by their parents
    and drops loops and repeats. Edges and parents of a round are written to the shared folder; only whether edges
    are left comes back to the driver. An empty table has no nodes.
    """
    renamed = edges.select(F.xxhash64("a").alias("x"), F.xxhash64("b").alias("y")).where("x <> y")
    left = durable(renamed.distinct(), "edges")
    both = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = both.select("node", F.xxhash64("node").alias("root"))
    while not left.isEmpty():
        ends = left.union(left.select("y", "x"))
        parents = ends.groupBy("x").agg(F.min("y").alias("least"))
        parents = durable(parents.select("x", F.least("x", "least").alias("parent")), "parents")
        of = lambda end: parents.select(F.col("x").alias(end), F.col("parent").alias(f"parent_{end}"))
        moved = left.join(of("x"), "x").join(of("y"), "y")
        low, high = F.least("parent_x", "parent_y"), F.greatest("parent_x", "parent_y")
        moved = moved.where("parent_x <> parent_y").select(low.alias("x"), high.alias("y")).distinct()
        roots = roots.join(of("root"), "root", "left")
        roots = roots.select("node", F.coalesce("parent_root", "root").alias("root"))
        left = durable(moved, "edges")
    return roots
