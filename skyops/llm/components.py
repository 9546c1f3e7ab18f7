"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.llm.common import stored


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def _with_least(links: DataFrame, key: str, least) -> DataFrame:
    """Each link with the least node around ``key``. An aggregate and a join, so a node with many links stays spread."""
    small = links.groupBy(F.col(key).alias("_key")).agg(F.min(least).alias("_least"))
    return links.join(small, F.col(key) == F.col("_key")).drop("_key")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every node of a link: the least node that links lead to.

    Links have no direction; loops and repeated links are allowed, links with a null end are not links. Every round
    first ties the larger neighbours of a node to its least neighbour (large star), then the smaller ones (small star);
    both keep the components, and the rounds end when all links lead to the least node. Rounds are written to the shared
    folder; only a count and a checksum of the links reach the driver.
    """
    start = links.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    )
    now = stored(start.distinct(), "links")
    before, mark = None, _mark(now)
    while mark != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, "u", F.least("u", "v")).where("v > u").select(F.col("v").alias("u"), F.col("_least").alias("v"))
        large = large.where("u <> v").distinct()
        small = _with_least(large, "u", F.col("v"))
        tied = small.select("u", F.col("_least").alias("v")).union(
            small.where("v <> _least").select(F.col("v").alias("u"), F.col("_least").alias("v"))
        )
        now = stored(tied.distinct(), "links")
        before, mark = mark, _mark(now)
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("node"), "component").distinct())
