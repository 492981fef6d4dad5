"""Connected components by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import stored

MAX_ROUNDS = 60
#: Links in one stored partition, so that few links do not take as many files as many do.
PARTITION_LINKS = 200_000


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``links`` (``a``, ``b``).

    Each round points the neighbours of a node to the smallest of them, first the
    larger ones (large star), then the smaller ones (small star). The number of
    links never grows and paths shorten by a factor per round, so a few rounds
    suffice. Minima are combined before the shuffle; a node with very many links
    is joined as a skewed key, never gathered. Links with a null end or of a node
    with itself are left out.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    parts = edges.count() // PARTITION_LINKS + 1
    edges, seen = edges.coalesce(parts), None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(smallest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = stored(large.coalesce(parts))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b"))).distinct()
        )
        edges = stored(small.coalesce(parts))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return stars.unionByName(stars.select("component", "component").toDF("node", "component").distinct())
        seen = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
