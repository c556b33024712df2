"""Connected components of a graph given as edges, by alternating star contractions.

A large-star step links every larger neighbour of a node to the smallest node
around it, a small-star step does so with its smaller neighbours and the node
itself. Neither changes the components, and both together end in stars around
the smallest node of each. Rounds grow with the logarithm of a component, and
every round is two aggregations and joins; nothing is gathered in one place. A
node with very many neighbours may be split over tasks in the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from razonete.llm.common import saved
from razonete.operators.joins import join_unique


def _star(near: DataFrame, large: bool) -> DataFrame:
    """`near` has rows (a, b): b is a neighbour of a. Links the neighbours of each node to the smallest around it."""
    least = near.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    joined = join_unique(near, least, "a", "inner")
    if large:
        linked = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b")))
    return linked.where("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node that has an edge to another; root is its smallest reachable node.

    Edges may repeat and point either way. Edges with a null end, and of a node to itself, count for nothing.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).isNull().alias("x"),
                         F.col(b).isNull().alias("y")).where("not x and not y and a != b").select("a", "b").distinct()
    edges = saved(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        stars = _star(both, large=True)
        # The larger end of every edge comes first, so its neighbours are the smaller ones.
        stars = stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges = saved(_star(stars, large=False), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
