"""Connected components of links, by rounds of star contraction.

Every round replaces links by links to the smallest neighbour, once on the side of the larger and once on
the side of the smaller nodes. The number of links never grows, and the components are stars after about
log(diameter) rounds. A node with many links is parted by adaptive execution. Each round is written to the
shared folder; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadpulse.llm import folders
from threadpulse.operators.skew import lookup_join


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "node")
    joined = lookup_join(both.where("b > a"), smallest, "a", "node")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links here go from the larger node a to the smaller b."""
    smallest = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(smallest, "a")  # a node has few smaller ones left
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").unionByName(
        smallest.select("a", F.col("m").alias("b"))
    )


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node reachable, for every node a or b of the links that is not it."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links = folders.written(links, "links")
    state = None
    while True:
        after = folders.written(_small_star(_large_star(links)).distinct(), "links")
        seen = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        links = after
        if seen == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = seen
