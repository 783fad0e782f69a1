"""Connected components of a table of links, by alternating large and small stars.

Every step is a grouping and a join on node ids, staged in the shared folder, so
neither links nor components reach the driver. Roots are the smallest ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.session import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest node around."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """b, a: every linked node but the roots, with its root; ``links`` has a < b."""
    now, before = stage(links.distinct(), "links"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before or not mark[0]:
            return now.select("a", "b")
        before, now = mark, stage(_small_star(_large_star(now)), "stars")
