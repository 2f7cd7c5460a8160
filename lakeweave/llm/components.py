"""Connected components by alternating star contractions (Kiveris et al.)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import stored


def contract(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with, for every node of the edges ``a``, ``b``.

    Each round links every node to the smallest of its neighbours, larger ones
    and then smaller ones; the edges of a component shrink to a star. A node of
    very many edges is a minimum that combines on the map side, and a join key
    that can be split.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("low"))
        pairs = large.join(small, "a")
        edges = stored(pairs.select("a", F.col("low").alias("b")).unionByName(
            pairs.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
