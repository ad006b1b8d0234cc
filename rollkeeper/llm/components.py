"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step joins the links with the least neighbour of each node, which is stored first, so
that a hub's links can be split over tasks. Links, not nodes, are kept; nothing of them
comes to the driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeeper.session import written


def _star(pairs: DataFrame, small: bool) -> DataFrame:
    """``pairs`` (u, v): ties u's neighbours (large: those above u; small: all of the given) to the least of them and u."""
    least = written(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
    joined = pairs.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return written(out.filter("a <> b").distinct(), "links")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) in any order: for each node but the least of its component (a, b), b being that least one."""
    links = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = _state(links)
    while state[0]:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, small=False)
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        links = _star(down, small=True)
        now = _state(links)
        if now == state:
            break
        state = now
    return links
