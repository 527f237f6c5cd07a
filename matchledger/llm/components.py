"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import Scratch


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest neighbour of each u, combined before the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of u moves to the smallest node around u."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """u and its smaller neighbours move to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of a link, roots (the smallest nodes) included.

    links: two columns of non-null longs; loops and repeated links do no harm.
    Each round rewires links so that every component comes closer to a star around
    its smallest node (Kiveris et al., Connected Components in MapReduce and
    Beyond). A round's links never outnumber the nodes by more than the round
    before, a node with very many links is combined before its shuffle, and the
    joins are of the kind whose skewed partitions Spark splits. Each round is a
    staged table; only a count and a checksum come to the driver.
    """
    a, b = links.columns
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    links = scratch.stage(links, "links")
    before = None
    while True:
        links = scratch.stage(_small_star(_large_star(links)), "stars")
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.hash("v", "u").cast("long"))
        ).first()
        if now == before or now[0] == 0:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select("v", "v").distinct()
    )
