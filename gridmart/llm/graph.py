"""Connected components of an undirected graph by rounds of contraction.

Each node points at its smallest neighbour (or itself), the pointers are followed to
their ends by pointer jumping, and the edges are rewritten between the ends that are left.
The number of rounds is logarithmic in the longest chain.  Every step is a join or a
grouping with map-side combining; each round's tables are written to the shared scratch
folder, so both sides of a join come straight from an exchange and adaptive execution can
split a hub that holds a large share of the edges.  No list of neighbours is built.  A
round's tables are deleted when the next one has read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges``: long columns ``a``, ``b``.  Returns one row for each node that has an edge to another
    node: ``node``, ``component`` (the smallest node that can be reached).  Nulls and loops are
    left out; no edges give no rows."""
    edges = scratch.write(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                                        F.least("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        pointer = scratch.write(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                                .select("node", F.least("node", "b").alias("component")), "pointer")
        while True:
            nxt = pointer.select(F.col("node").alias("component"), F.col("component").alias("further"))
            jumped = scratch.write(pointer.join(nxt, "component").select(
                "node", F.col("further").alias("component"),
                (F.col("further") != F.col("component")).alias("moved")), "jump")
            moved = not jumped.filter("moved").isEmpty()
            scratch.drop(pointer)
            pointer = jumped.drop("moved")
            if not moved:
                break
        a = pointer.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        b = pointer.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        left = scratch.write(edges.join(a, "a").join(b, "b").filter("ca <> cb").select(
            F.greatest("ca", "cb").alias("a"), F.least("ca", "cb").alias("b")).distinct(), "edges")
        scratch.drop(edges)
        if labels is None:
            labels = pointer
        else:
            root = pointer.select(F.col("node").alias("component"), F.col("component").alias("root"))
            further = scratch.write(labels.join(root, "component", "left").select(
                "node", F.coalesce("root", "component").alias("component")), "labels")
            scratch.drop(labels)
            scratch.drop(pointer)
            labels = further
        edges = left
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    scratch.drop(edges)
    return labels
