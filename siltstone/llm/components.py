"""Connected components of an edge table, without a graph on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.sources.stage import stage


def _hang(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang the neighbours of each node, its larger ones or all others, on its least neighbour or itself.

    Only the least neighbour is aggregated, with a partial step before the shuffle; the neighbours stay
    rows, so a node with very many of them is split by the skew join.
    """
    both = edges if not larger else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written, so that the join has an exchange on either side and skewed partitions can be split
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    joined = both.join(least, "a")
    if larger:
        hung = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        hung = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
    return hung.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the least node it is connected with, of every node but the roots.

    `edges` has long columns `a` and `b`; direction, repeated edges, loops and null ends do not matter, an
    edge with a null end links nothing.  Alternates large-star and small-star steps, each a pair of joins
    whose result is written to the shared folder, until nothing changes; their number grows with the
    logarithm of the largest component.  Runs jobs.
    """
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a is not null and b is not null and a <> b").distinct()
    current, seen = stage(current, "edges"), None
    while True:
        current = stage(_hang(stage(_hang(current, True), "stars"), False), "stars")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
