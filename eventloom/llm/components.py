"""Connected components by alternating stars, table by table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for the ends of ``links`` (a, b): the smallest id reachable.

    Large-star and small-star steps in turn (Kiveris et al., "Connected
    components in MapReduce and beyond") until the links are stars around the
    smallest ids; the centres are not listed. Each step joins on ids against a
    staged minimum per id, so a centre with very many links is split by the join
    and never gathered. Links with a null end, and from an id to itself, count
    for nothing.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "large-star")
        # every larger neighbour is tied to the smallest one
        pulled = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stage(pulled.distinct(), "large-links")
        least = stage(large.groupBy("a").agg(F.min("b").alias("least")), "small-star")
        pushed = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stage(pushed.unionByName(least.withColumnRenamed("least", "b")).distinct(), "links")
        ends = edges.select("a", F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
        tangled = ends.groupBy("a").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where("child > 1 or (child = 1 and parent = 1)")
        if tangled.isEmpty():
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
