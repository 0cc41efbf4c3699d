"""Connected components of an edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemat.scratch import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the smallest of itself and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours on the smallest of them. Here a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").filter(F.col("a") != F.col("m"))
    return moved.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(least.select(F.col("m").alias("a"), "b"))


def smallest_reachable(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, smallest`` for every node of an edge that is not the smallest of its component.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest path. Neighbours
    of one node meet only in partial aggregates and joins, which adaptive execution may split.
    """
    x, y = F.col(a), F.col(b)
    now = stage(
        edges.filter(x != y).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct(), "edges"
    )
    before = _state(now)
    while before[0]:
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("smallest"))
