"""Connected components of an edge table by alternating large-star / small-star steps.

Every step is one aggregation (pre-aggregated before its shuffle) and one
join; nothing is collected per node, so a star of any size is only rows. Each
round is written to the shared checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Takes and returns edges with ``v < u``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` and no ``v`` is itself a ``u``."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
    chained = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return twice.unionAll(chained).isEmpty()


def component_labels(edges: DataFrame) -> DataFrame:
    """``(u, v)``: each node that is not its component's smallest, and that smallest.

    ``edges(u, v)`` may point either way and repeat; loops, and edges with a null
    at either end, are ignored. An empty table gives an empty result.
    """
    edges = edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = staged(edges, "edges")
    while not _is_stars(edges):
        edges = staged(_small_star(_large_star(edges)), "stars")
    return edges
