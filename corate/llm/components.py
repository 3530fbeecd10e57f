"""Connected components by contraction.

Every round hooks each node to its smallest neighbour and contracts the
edges; nodes are hashes, so their order is random and the graph shrinks by
a constant share a round. Node maps of the rounds are joined back in
reverse. Edges, nodes and maps stay in tables; the driver only learns
whether edges are left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.config import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): nodes have equal roots
    if and only if edges connect them. Self-loops are ignored. An empty
    table gives an empty result."""
    current = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps = []
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("parent")).withColumnRenamed("a", "node"), "hooks")
        maps.append(hooks)
        left = hooks.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = hooks.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = current.join(left, "a").join(right, "b").where("pa <> pb")
        current = materialize(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false")
    roots = maps.pop().withColumnRenamed("parent", "root")
    while maps:
        later = roots.select(F.col("node").alias("parent"), "root")
        roots = maps.pop().join(later, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    return roots
