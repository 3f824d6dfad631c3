"""Connected components of an edge table, by alternating star contraction.

Each round links every node to its smallest known neighbour, first over larger
neighbours, then over smaller ones; the edge table shrinks to stars around the
smallest node of each component. Every round is a written table, so a lost
executor re-reads files. The driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatework.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m"))
    joined = both.join(least, "a").where(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.least("a", "_m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    joined = down.join(least, "a")
    linked = joined.where(F.col("b") > F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return linked.unionByName(least.select("a", F.col("_m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint); component is the smallest node.

    An empty edge table gives no rows; loops and repeated edges are ignored;
    an edge with a null end is ignored.
    """
    edges = stage(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = stage(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    least = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        least.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )
