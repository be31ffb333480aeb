"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.session import store



def digest(links: DataFrame) -> tuple:
    """Count and two sums of hashes of distinct links: equal tables give equal ones."""
    hashes = F.xxhash64("a", "b")
    return tuple(links.agg(F.count("*"), F.bit_xor(hashes), F.sum(hashes.cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link in (a, b): root is the smallest node reachable.

    Alternates large-star and small-star steps: links are moved to the smallest neighbour until all components are
    stars. Each step is one aggregation and one join; its result is written to the shared folder, so that a step can be
    repeated from there when executors are lost. Null and self links are left out.
    """
    links = store(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    now = digest(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(least, "a")
        small = moved.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        ).where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        links, before = store(small, "links"), now
        now = digest(links)
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
