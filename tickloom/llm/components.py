"""Connected components of links between documents, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.session import materialize

ROUNDS = 60  # far beyond the logarithmic number that any graph takes; reaching it is an error


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link all larger neighbours of a node to the least of its neighbourhood."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("least", "a").alias("least"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Edges point from the larger to the smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    inner = edges.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return inner.unionByName(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """The least node that each linked node reaches: node, component (itself included only where it is larger).

    ``links`` (a, b) holds integers; loops and repeats are ignored. Each round ends in a stored table; sums over
    neighbours are pre-aggregated, and joins on a hub can be split by its rows. Ends when every edge is a star's.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = materialize(links.where("a <> b").select(larger, smaller).distinct(), "edges")
    before = _content(edges)
    for _ in range(ROUNDS):
        edges = materialize(_small_star(_large_star(edges)).distinct(), "edges")
        now = _content(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
    raise RuntimeError("components did not settle")


def _content(edges: DataFrame):
    """Enough to tell whether a round changed anything: the count of edges and two sums over their hashes."""
    return edges.agg(
        F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))
    ).first()
