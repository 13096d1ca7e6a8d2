"""Connected components of a link table, in tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def connected_components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(id, component)`` for every id in ``links`` (columns a, b, long): the smallest id reachable.

    Large-star and small-star rounds: every round hangs neighbours on the smallest one seen, and
    the number of rounds grows with the logarithm of the longest chain. ``known`` (id, component)
    may give links found earlier. Null ends and loops are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    if known is not None:
        edges = edges.unionByName(known.select(F.col("id").alias("a"), F.col("component").alias("b")))
    edges = materialize(edges.where("a > b").distinct())
    mark = None
    while True:
        # Large star: larger neighbours of a node move to its smallest neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        edges = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a")
        moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        edges = materialize(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
