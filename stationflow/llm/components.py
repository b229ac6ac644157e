"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.scratch import Scratch


def _small_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (edges have a > b); no more rows than ``edges``."""
    least = scratch.table(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs) that isn't its own root.

    ``root`` is the smallest node of the component.  The rounds grow with the
    logarithm of the component's width; each is written to the shared folder.
    Rows with a null end or two equal ends link nothing; edges may repeat.

    A large star links every larger neighbour of a node to the smallest of the node
    and its neighbours.  The least neighbours are written before their join, here and
    in the small star: beside an aggregate in its stage, AQE can't split the node of a
    large star.  They also tell the end, without a round that changes nothing: all is
    done when no node with a smaller neighbour has any other neighbour.
    """
    stars = scratch.table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "stars")
    while True:
        both = stars.select("a", "b").unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = both.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("most"))
        least = ends.select("a", F.least("a", "m").alias("m"), F.expr("m < a AND m < most").alias("open"))
        least = scratch.table(least, "least")
        if not least.agg(F.max("open")).first()[0]:
            return least.where("m < a").select(F.col("a").alias("node"), F.col("m").alias("root"))
        larger = both.join(least.select("a", "m"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = scratch.table(larger, "larger")
        stars = scratch.table(_small_star(larger, scratch), "stars")
