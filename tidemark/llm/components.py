"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def _star_step(edges: DataFrame) -> DataFrame:
    """Large star, then small star, of ``edges`` (a, b) with a > b; what both give is again of this form."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # one row an edge, so what repeats can wait for the end of the step
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    # the row of the least neighbour keeps it, those of the others move there
    return large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has one edge, to its centre."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up + down > 1 AND up > 0").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); the label is the smallest node reachable.

    Large-star and small-star steps alternate until the edges are stars, each
    of a component around its smallest node.  A hub is never gathered: its
    neighbours meet in a combinable minimum and a join that adaptive execution
    may split.  Self-loops and repeated edges do no harm.
    """
    edges = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _are_stars(edges):
        edges = cut_lineage(_star_step(edges))
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots.select("node", F.col("node").alias("label")))
