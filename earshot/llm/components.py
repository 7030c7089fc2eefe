"""Connected components by alternating large-star and small-star steps.

Each step moves links towards the smallest id in reach, with one aggregation and one
join; the number of rounds grows with the logarithm of the longest chain. Each round is
stored, so lineage never grows, and neither links nor components reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); the component is its smallest id."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, state = stored(links, "links"), None
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        # all links lead to a smallest id exactly when a round changes nothing
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return ends.unionByName(roots)
