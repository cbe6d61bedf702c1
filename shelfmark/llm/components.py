"""Connected components of links, as DataFrames throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One alternating step: each node ties its (larger) neighbours to its smallest one."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.where("a > b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    tied = both.join(least, "a")
    if larger:
        tied = tied.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        own = least.select("a", F.col("least").alias("b"))
        tied = tied.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own)
    return tied.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """For links (a, b): node and component, the smallest node reachable.

    Large and small stars alternate until nothing changes, in a number of rounds that
    grows with the logarithm of the longest path.  Each round is a written table; only
    a count and a checksum come to the driver."""
    now = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    seen = None
    while True:
        sums = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20)")).alias("s")).first()
        if seen == (sums.n, sums.s):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = (sums.n, sums.s)
        now = stored(_star(stored(_star(now, True), "large-star"), False), "small-star")
