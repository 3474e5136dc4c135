"""Connected components of a table of links, as rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least node among its neighbours and itself."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; root is the least node of its component.

    links has columns a and b of one orderable type without nulls. Large-star and small-star rounds alternate
    until nothing changes; their number grows with the logarithm of the longest path. Every round is
    written to the shared folder, so a lost executor costs one round at most. Nodes and links stay
    distributed; what comes to the driver is a count and a checksum a round.
    """
    now = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = _mark(now)
    while mark[0]:
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _mark(links: DataFrame) -> tuple[int, int]:
    got = links.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(2**31)))).first()
    return got[0], got[1] or 0
