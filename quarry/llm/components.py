"""Connected components of an edge table as Spark jobs (alternating star contraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` bigint edges -> ``(node, root)`` for every node that has an edge
    to another; ``root`` is the smallest node of its component.

    Each round hooks every node's larger neighbours to the smallest node around
    it, then every node's smaller neighbours to the smallest of them.  Minima are
    aggregated before the shuffle, so a hub costs one row per task.  Rounds are
    written to the checkpoint folder; they number about the logarithm of the
    longest path."""
    e = materialize(edges.where("u <> v").select(F.least("u", "v").alias("u"),
                                                 F.greatest("u", "v").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(MAX_ROUNDS):
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the minima are written, so that the join below reads both sides through
        # shuffles of its own and Spark can split a hub's rows
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "cc-low")
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("m").alias("u"), "v").where("u <> v").distinct())
        large = materialize(large, "cc-large")
        low = materialize(large.groupBy("v").agg(F.min("u").alias("m")), "cc-low")
        small = (large.join(low, "v").where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))
                 .unionByName(low.select(F.col("m").alias("u"), "v")).distinct())
        e = materialize(small, "cc")
    else:
        raise RuntimeError("components did not settle")
    nodes = e.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return nodes.unionByName(e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
