"""Connected components by alternating large and small stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) that is not a root; root is the least node it can reach.

    A round links each node to the least of its neighbours, first for larger neighbours, then for smaller ones, so
    the number of rounds grows with the logarithm of the longest path. Minima are taken before rows are shuffled, and
    both sides of each join are written tables, so that Spark can split a node with very many links.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    pairs = stage(pairs, "links")
    before = None
    while (now := signature(pairs)) != before:
        before = now
        pairs = small_star(large_star(pairs))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def signature(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), "least")
    linked = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    return stage(linked, "links")


def small_star(pairs: DataFrame) -> DataFrame:
    least = stage(pairs.groupBy("u").agg(F.min("v").alias("low")), "least")
    others = pairs.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return stage(others.unionByName(least.select("u", F.col("low").alias("v"))).distinct(), "links")
