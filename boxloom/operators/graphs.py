"""Greedy selection and connected components over an edge table, in rounds of joins.

Used for groups too large for one task. Each round is a few shuffles of the
remaining edges, which shrink from round to round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.cluster import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); root = smallest node reached.

    Alternates large-star and small-star steps, which need a logarithmic number
    of rounds on chains. Neighbourhoods are never gathered: each step is a
    minimum per node and a join.
    """
    edges = cut(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where(F.col("a") != F.col("b")).distinct()
    )
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b"))
    current = edges
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
        large = (
            both.where(F.col("b") > F.col("a")).join(low, "a")
            .select(F.col("m").alias("a"), "b").where(F.col("a") != F.col("b")).distinct()
        )
        large = cut(large)
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(low, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
            .union(low.select(F.col("m").alias("x"), F.col("b").alias("y")))
            .where(F.col("x") != F.col("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        small = cut(small)
        stable = small.exceptAll(current).isEmpty() and current.exceptAll(small).isEmpty()
        current = small
        if stable:
            break
    root = current.groupBy("b").agg(F.min("a").alias("root"))
    return (
        nodes.distinct().join(root, F.col("node") == F.col("b"), "left")
        .select("node", F.coalesce("root", "node").alias("root"))
    )


def greedy_dropped(edges: DataFrame) -> DataFrame:
    """Nodes a first-come selection drops, over ``edges`` (a before b).

    A node is kept when no earlier neighbour was kept. A round settles all nodes
    whose earlier neighbours are settled.
    """
    edges = cut(edges.select("a", "b").distinct())
    dropped = None
    while not edges.isEmpty():
        # nodes with no unsettled earlier neighbour are kept
        kept = edges.select(F.col("a").alias("n")).distinct().join(
            edges.select(F.col("b").alias("n")).distinct(), "n", "left_anti"
        )
        gone = cut(edges.join(kept.withColumnRenamed("n", "a"), "a", "left_semi")
                   .select(F.col("b").alias("n")).distinct())
        dropped = gone if dropped is None else dropped.union(gone)
        edges = cut(
            edges.join(gone.withColumnRenamed("n", "a"), "a", "left_anti")
            .join(gone.withColumnRenamed("n", "b"), "b", "left_anti")
        )
    return dropped
