"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself to the smallest of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def partial(edges: DataFrame) -> DataFrame:
    """(node, label) after one large-star and one small-star step: nodes of one label are connected.

    Connected nodes may still bear different labels. A label is a node that is no larger; nodes that
    are their own label have no row.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return _small_star(_large_star(now)).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none itself."""
    two = edges.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("n")).where("m < n").select("a")
    return two.union(edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b) that is not the smallest of its component.

    ``component`` is the smallest node reachable. Edges may repeat, run either way or join a node to
    itself; rows with a NULL are ignored. No edges give no rows. Minima are combined before they are
    shuffled and the joins are ordinary equi-joins, so a node with very many edges needs no task that
    holds them. Each round is written to the shared folder; rounds grow with the logarithm of the size.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = settle(now, "edges")
    while not _stars(now):
        now = settle(_small_star(_large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
