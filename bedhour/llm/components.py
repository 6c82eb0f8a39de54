"""Connected components by alternating large-star and small-star.

Every round replaces the edges of a node by edges to the smallest node near it;
nothing but minima is gathered per node, so a node with very many edges is never
one task's work, and each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, apart


def _star(edges: DataFrame) -> DataFrame:
    """Large-star: neighbours above a node are linked to its smallest neighbour
    or itself. ``edges`` has both directions."""
    least = edges.groupBy("u").agg(F.min("v").alias("least")).select(
        apart(F.col("u")).alias("node"), F.least("u", "least").alias("least")
    )
    return (
        edges.where(F.col("v") > F.col("u"))
        .join(least, F.col("u") == F.col("node"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Small-star: a node and its smaller neighbours are linked to the smallest
    of them. ``edges`` point from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("least")).select(apart(F.col("u")).alias("node"), "least")
    linked = edges.join(least, F.col("u") == F.col("node"))
    across = linked.where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return across.union(least.select(F.col("node").alias("u"), F.col("least").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node but the smallest has one edge, straight to it."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    degree = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degree.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(pairs: DataFrame) -> Stage:
    """``u, v``: every node with edges except the smallest of its component (u),
    and that smallest node (v). ``pairs`` has two long columns; direction,
    repeats, loops and nulls do not matter."""
    a, b = pairs.columns
    edges = Stage(
        pairs.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "star",
    )
    while not _settled(edges.df):
        both = edges.df.union(edges.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # One row per edge, so repeats are left to the next step.
        large = _star(both).where(F.col("u") != F.col("v"))
        after = Stage(_small_star(large), "star")
        edges.drop()
        edges = after
    return edges
