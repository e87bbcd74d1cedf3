"""Connected components by contraction, on tables that are written between the steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def follow(pointers: DataFrame) -> DataFrame:
    """Pointer jumping: replaces ``to`` by the root that it leads to."""
    while True:
        further = pointers.select(F.col("node").alias("_via"), F.col("to").alias("_far"))
        jumped = cut(pointers.join(further, F.col("to") == F.col("_via"), "left")
                     .select("node", F.coalesce("_far", "to").alias("to"), F.col("_far").isNotNull().alias("_moved")))
        pointers = jumped.select("node", "to")
        if jumped.filter("_moved").isEmpty():
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """(node, to) for every node that is not the smallest of its component; ``to`` is the smallest.

    ``edges`` has two columns of ids, ``a`` and ``b``. In each round every node
    points at its smallest neighbour if that is smaller than itself, pointers
    are followed to their roots, and the edges between different roots are the
    next round's graph. Every step is a join or a minimum with map-side combine
    between written tables, so a hub's rows can be split by adaptive execution;
    no task holds a component.
    """
    graph = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    found = None
    while True:
        pointers = follow(cut(graph.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("to"))))
        if found is None:
            found = pointers
        else:
            p = pointers.select(F.col("node").alias("_root"), F.col("to").alias("_new"))
            moved = found.join(p, F.col("to") == F.col("_root"), "left").select("node", F.coalesce("_new", "to").alias("to"))
            found = cut(moved.unionByName(pointers))
        left = pointers.select(F.col("node").alias("hi"), F.col("to").alias("_h"))
        right = pointers.select(F.col("node").alias("lo"), F.col("to").alias("_l"))
        roots = (graph.join(left, "hi", "left").join(right, "lo", "left")
                 .select(F.coalesce("_h", "hi").alias("x"), F.coalesce("_l", "lo").alias("y")).filter("x <> y"))
        graph = cut(roots.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct())
        if graph.isEmpty():
            return found
