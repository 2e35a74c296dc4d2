"""Connected components of a graph too large for the driver, by alternating stars.

Each round replaces links by links to smaller neighbours (large star: every
larger neighbour of a node to the node's smallest one; small star: every
smaller neighbour and the node itself to the smallest one) until only stars
around each component's smallest node are left; the number of rounds grows with
the logarithm of the longest chain.  Rounds are aggregates and equi-joins over
written tables, so a node with very many links is pre-aggregated and its join
partition can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.session import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star round over distinct links (u, v) with u > v."""
    if large:
        seen = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = links
    least = materialize(seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
    joined = seen.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return materialize(out.filter("u > v").distinct(), "stars")


def _print(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b) but the roots; root is the component's smallest node."""
    now = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    before, state = None, _print(now)
    while state != before and state[0]:
        now = _star(_star(now, large=True), large=False)
        before, state = state, _print(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
