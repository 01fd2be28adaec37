"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every end of an edge ``a, b``; a component is named by its smallest node.

    Each round, every node points to its smallest neighbour or itself, found by an aggregate that
    is combined before the shuffle; pointers are followed to their ends; and edges between different
    ends make the graph of the next round, in which at most half of the nodes are left. No node's
    neighbours are ever gathered, and every round is written to the shared folder.
    Edges with a null end are ignored; loops give a component of one node; no edges give no rows.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    rest = materialise(edges.where("a <> b").distinct(), "edges")
    known = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    found = materialise(known.withColumn("component", F.col("node")), "components")
    while not rest.isEmpty():
        ends = rest.union(rest.select("b", "a"))
        parents = ends.groupBy("a").agg(F.min("b").alias("b"))
        parents = materialise(parents.select("a", F.least("a", "b").alias("p")), "parents")
        while True:
            up = parents.select(F.col("a").alias("p"), F.col("p").alias("q"))
            moved = materialise(parents.join(up, "p").select("a", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("m")), "parents")
            if moved.where("m").isEmpty():
                break
            parents = moved.select("a", "p")
        left, right = parents.select("a", F.col("p").alias("pa")), parents.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        moved = rest.join(left, "a").join(right, "b").where("pa <> pb")
        low, high = F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")
        rest = materialise(moved.select(low, high).distinct(), "edges")
        up = parents.select(F.col("a").alias("component"), F.col("p").alias("q"))
        found = materialise(
            found.join(up, "component", "left").select("node", F.coalesce("q", "component").alias("component")), "components"
        )
    return found
