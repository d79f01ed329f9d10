"""Connected components of a graph given as an edge table.

Alternating large-star and small-star rounds: every round is two aggregations
by node and two joins, so neither the edges nor the components ever meet in
one task or on the driver. Each round's edges are written to the shared
folder, which keeps the lineage short when executors are lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialise


def _towards_minimum(pairs: DataFrame) -> DataFrame:
    """``pairs`` (node, other) with the smallest of node and its others."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(least.select("node", F.least("node", "least").alias("least")), "node")


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node that occurs in an edge.

    ``component`` is the smallest node of the component. Null ends and loops
    are ignored; an empty edge table gives an empty result.
    """
    current = edges.select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")) \
        .where((F.col(left) != F.col(right))).distinct()
    current = materialise(current, "edges")
    signature = None
    while True:
        # large star: larger neighbours of a node attach to its smallest one
        both = current.select(F.col("hi").alias("node"), F.col("lo").alias("other")) \
            .unionByName(current.select(F.col("lo").alias("node"), F.col("hi").alias("other")))
        large = _towards_minimum(both).where("other > node") \
            .select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()
        # small star: a node and its smaller neighbours attach to the smallest
        starred = _towards_minimum(large)
        small = starred.select(F.explode(F.array("node", "other")).alias("hi"),
                               F.col("least").alias("lo")).where("hi != lo").distinct()
        current = materialise(small, "edges")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == signature:
            break
        signature = tuple(now)
    nodes = current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return nodes.unionByName(roots)
