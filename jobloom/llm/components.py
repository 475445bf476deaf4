"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("low").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    return down.join(least, "a").where("b <> low").select(F.col("low").alias("a"), "b").union(least.select(F.col("low").alias("a"), F.col("a").alias("b")))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): every node that has an edge, with the smallest node it can reach.

    `edges` has long columns `a`, `b` without nulls; direction, repeats and loops do not
    matter. Each round is written to the shared folder and only its row count and hash
    sum come back; rounds end when the edges no longer change, which is when each
    component is a star around its smallest node.
    """
    now = settle(spark, edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        stars = _small_star(_large_star(now).distinct()).where("a <> b").distinct()
        now = settle(spark, stars, "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 2**40)).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
