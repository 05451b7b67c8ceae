"""Connected components by contraction in a logarithmic number of rounds.

Each round gives every node a fresh random rank and moves it to the lowest-ranked node
among itself and its neighbours; edges follow their ends, and edges inside a node vanish.
A path shrinks by about half a round whatever its numbering, so a chain of a thousand
takes some ten rounds.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import stored


def contract(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of the edges (a, b); root is one node of the component."""
    edges = stored(edges.where("a <> b"), "components-edges")
    labels, step = None, 0
    while not edges.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(step), c).alias("rank"), F.col(c).alias("node"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("best"))
        parents = stored(best.select(F.col("a").alias("node"), F.least("best", rank("a"))["node"].alias("parent")), "components-parents")
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("root"))
        else:
            moved = parents.select(F.col("node").alias("root"), "parent")
            labels = stored(labels.join(moved, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "components-labels")
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        ends = edges.join(of_a, "a").join(of_b, "b")
        ends = ends.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = stored(ends.where("a <> b").distinct(), "components-edges")
        step += 1
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
