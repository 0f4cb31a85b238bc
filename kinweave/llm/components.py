"""Connected components of links, by alternating large and small stars: each round is a few shuffles of narrow rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.scratch import stored
from kinweave.operators.skew import lookup


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``m``, the least of u and its neighbours. A node with very many edges can be split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").cast("string").alias("_u"), "m")
    found = lookup(edges.withColumn("_u", F.col("u").cast("string")), least, "_u", "inner")
    return found.select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _least_neighbour(both).filter(F.col("v") > F.col("u"))
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    found = _least_neighbour(edges)
    moved = found.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(found.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label``: for each node with a link to a smaller one reachable from it, the smallest reachable node.

    ``links`` has two columns of whole numbers; direction, repetition and links of a node to itself do not matter. A
    node that is the smallest of its component, or has no links, is not listed.
    """
    a, b = (F.col(c) for c in links.columns)
    edges = stored(links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while not _are_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour, which has none itself."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    found = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return found.filter((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)).isEmpty()
