"""Connected components of an edge table by alternating large and small stars.

Each step is a group-by (partial minimum before the shuffle) and a join on the node, so a node with
very many neighbours is one row per task in the group-by, and run-time skew handling splits it in the
join. The edges are written to the shared folder after each step, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scratch import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Join the neighbours of each node (the larger ones, or the smaller ones) to its least neighbour."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.unionByName(turned) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.join(least, "a")
    if large:
        return moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    # a smaller neighbour goes to the least one, and so does the node itself
    return (
        moved.filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .filter("a <> b")
        .distinct()
    )


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node has two smaller neighbours, or neighbours on both sides. The
    centre of a star is then its least node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count("*").alias("all"))
    return not nodes.agg(F.count_if((F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("all") > 1)))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: bigint); root is the least node it reaches."""
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _settled(edges):
        edges = written(_stars(written(_stars(edges, True)), False))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return written(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots))
