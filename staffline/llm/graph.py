"""Connected components by rounds of joins, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component) of every node of the edges (a, b); a component is named by its smallest id.

    Alternates large-star and small-star steps: every edge set is replaced by
    stars around smaller and smaller neighbours until nothing changes, which
    takes a logarithmic number of rounds. Self edges and repeated edges are fine.
    """
    current = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .distinct(), f"{name}-cc")
    while True:
        before = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before["n"] == 0:
            break
        # large star: every larger neighbour of u (and u) to the smallest of u's neighbourhood
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), f"{name}-min")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = materialize(large.distinct(), f"{name}-large")
        # small star: every smaller neighbour of u, and u, to the smallest of them
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-min")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        current = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-cc")
        after = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if after == before:
            break
    nodes = current.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    roots = current.select(F.col("v").alias("id")).distinct().join(nodes, "id", "left_anti")
    return materialize(nodes.unionByName(roots.select("id", F.col("id").alias("component"))), f"{name}-labels")
