"""Connected components of a link table, as Spark joins.

Alternating large-star and small-star steps (Kiveris et al., 2014) replace each
node's links by links to the smallest neighbour until nothing changes.  Each
node's minimum is a partial aggregate, and links meet it by an equi-join that
Spark can split, so a node with very many links is never one group in one task.
Each step is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    least = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    lowered = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lowered.union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links of long ids -> (node, component), the component being its smallest node.

    Nodes without links do not appear; links to itself, repeated and null links are ignored.
    """
    links = stored(links.filter("u IS NOT NULL AND v IS NOT NULL AND u != v").select("u", "v").distinct(), "links")

    def mark(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    last = None
    while (now := mark(links)) != last:
        last = now
        if not now[0]:
            break
        links = stored(_small_star(stored(_large_star(links), "large-star")), "small-star")
    # a star per component now: every node but the smallest points to it
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select("v", "v").distinct())


def roots(parents: DataFrame) -> DataFrame:
    """(u, v) links, each v once and no cycles -> (node, component), the component being the root above the node.

    Each step doubles how far a node looks up, so the steps are few; roots appear as their own component.
    """
    now = stored(parents.select("u", "v"), "parents")
    while True:
        up = now.select(F.col("v").alias("u"), F.col("u").alias("above"))
        now = stored(now.join(up, "u", "left").select(F.coalesce("above", "u").alias("u"), "v",
                                                      F.col("above").isNotNull().alias("moved")), "parents")
        if now.filter("moved").isEmpty():
            return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(now.select("u", "u").distinct())
        now = now.select("u", "v")
