"""Connected components by alternating large-star and small-star rounds over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpipe.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    return edges.agg(
        F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))
    ).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return (
        both.filter("y > x")
        .join(least, "x")
        .select(F.col("m").alias("x"), "y")
        .filter("x < y")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them. Rows have x < y."""
    least = edges.groupBy("y").agg(F.min("x").alias("m"))
    joined = edges.join(least, "y")
    return (
        joined.select(F.col("m").alias("x"), F.col("x").alias("y"))
        .union(least.select(F.col("m").alias("x"), "y"))
        .filter("x < y")
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is linked with) of all nodes with an edge.

    ``edges`` has the numbers ``x`` and ``y`` in any order; loops and repeated edges do no harm,
    rows with a null are no edges. Every round is one written table. When no round changes
    anything, every node hangs on its root.
    """
    ordered = (
        edges.filter("x != y")
        .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .distinct()
    )
    current = materialize(ordered, "edges")
    state = _state(current)
    while state[0]:
        current = materialize(_small_star(_large_star(current)), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(F.col("y").alias("node"), F.col("x").alias("root")).union(
        current.select(F.col("x").alias("node"), F.col("x").alias("root")).distinct()
    )
