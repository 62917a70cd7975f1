"""Connected components of an undirected graph by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each vertex's larger neighbours to the least of itself and its neighbours.

    The least is a partial aggregate, and the join back is one that Spark splits where a vertex has very
    many edges.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("least"))
    return both.join(least, "a").where("b > a AND b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each vertex and its smaller neighbours to the least of these; edges run from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return (edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(least.select("a", F.col("least").alias("b"))).where("a != b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (a, b) reaches.

    Each round is written to the shared folder, which cuts the lineage; rounds grow with the
    logarithm of the longest chain. Only counts reach the driver. Nodes without an edge are not in the
    result; loops, repeated edges and edges with null are harmless.
    """
    now = stored(edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not now.isEmpty():
        now = stored(_small_star(_large_star(now)), "stars")
        # done when every vertex has one edge, to a vertex that has none
        per = now.groupBy("a").agg(F.count("*").alias("n"))
        if per.where("n > 1").isEmpty() and now.join(per.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
