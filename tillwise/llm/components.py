"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators.skew import skew_safe_join

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """Rows node, component (the smallest node reachable) for links with columns a and b.

    Links are replaced by links to the smallest neighbour, alternately for the larger
    and for the smaller side, until every node points at the smallest of its component.
    Each round groups with partial minima and joins a hub's links back split by skew.
    """
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = skew_safe_join(both, low, ["a"], "inner").filter("b > a and b > low")
        links = stored(large.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "links")
        low = links.groupBy("a").agg(F.min("b").alias("low"))
        small = skew_safe_join(links, low, ["a"], "inner")
        small = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b")).filter("a > b")
        links = stored(small.distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    low = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(low)
