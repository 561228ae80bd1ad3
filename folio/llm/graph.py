"""Connected components of edges, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, written


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the least node that each node reaches. Only nodes of edges are returned.

    A round links each node with its least neighbour below, its others below with that one, and whatever is linked with a node
    that has a neighbour below with the least of these: the edges never outnumber the input, and chains halve. A round is an
    aggregation by node, pre-aggregated before its shuffle, and two joins of written tables by shuffles, which Spark can
    split where a node is hot; nothing is broadcast through the driver. Null ends and self-links are dropped."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v")
    e = written(e.distinct())
    for _ in range(rounds):
        least = written(e.groupBy("u").agg(F.min("v").alias("m")))
        hung = e.join(least.hint("merge"), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), "m", (F.col("v") != F.col("m")).alias("moved"))
        hung = hung.join(least.select(F.col("u").alias("m"), F.col("m").alias("top")).hint("merge"), "m", "left")
        before, e = e, written(hung.select("u", F.coalesce("top", "m").alias("v"), (F.col("moved") | F.col("top").isNotNull()).alias("moved")))
        removed(before)
        removed(least)
        if e.where("moved").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    before, e = e, written(e.select("u", "v").distinct())
    removed(before)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
