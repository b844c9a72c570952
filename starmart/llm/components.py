"""Connected components of an edge table, by alternating large and small stars.

Each step replaces every vertex's edges by edges to the smallest neighbour it
knows; minima are partial aggregates and the edges are joined back, so a vertex
with very many edges is never one task's list. Every step is written to the
shared folder; only a count reaches the driver. The steps end when the edges are
stars: a step that changes nothing is not needed to tell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _toward_minimum(edges: DataFrame, larger: bool) -> DataFrame:
    """edges (u, v), u > v: large star over both directions, or small star. As many rows
    as edges; some may be equal."""
    if larger:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    # the edge to the smallest neighbour stays, the others lead there
    return edges.join(least, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))


def _beyond_stars(edges: DataFrame) -> int:
    """Vertices with edges to several smaller ones, or to both smaller and larger ones."""
    ends = edges.select("u", F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("u").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or down = 1 and up = 1").count()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, root) for every vertex with an edge in ``edges`` (a, b); ``root`` is the
    smallest id of its component."""
    now = staged(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while _beyond_stars(now):
        now = staged(_toward_minimum(_toward_minimum(now, True), False).distinct(), name)
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
