"""Connected components as rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``links`` (a long, b long); comp is the
    smallest node that can be reached.

    Alternates the large-star and small-star operations until the links no
    longer change; every round is written to the shared folder.  Minima are
    partly aggregated before their shuffle, so a node with very many links is
    one row per task, and its joins are splittable.
    """
    # every link points from the larger to the smaller node
    now = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
                now.select("v", F.col("v").alias("w")).distinct())
        seen = mark
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.union(least.select("u", "m")).distinct(), "links")
