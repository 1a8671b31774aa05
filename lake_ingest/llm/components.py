"""Connected components by alternating large and small stars, on shared storage between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lake_ingest.llm.shared import saved


def _least(edges: DataFrame) -> DataFrame:
    """Per node ``u`` the least of it and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def _state(edges: DataFrame) -> tuple:
    """Number and sum of hashes of different edges: the same only for the same edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(u, root)``: per node of the undirected edges ``(u, v)`` the least node it is connected with.

    Each round links every node to the least of its neighbourhood; only minima are aggregated, so a node
    with very many edges is no group of its own. Rounds end when the edges stay the same, after a
    number of rounds that grows with the logarithm of the longest path; stars need one.
    """
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = saved(small, "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    stars = now.select("u", F.col("v").alias("root"))
    return stars.unionByName(now.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
