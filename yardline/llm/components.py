"""Connected components of links, however long a chain or large a component is.

Links are rewired to smaller nodes in turn, once towards the smallest neighbour of the larger end, once of the
smaller end (star contraction), until every node hangs on the smallest of its component. Each round is two
aggregations and joins over the links, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.llm.common import lookup, settle


def _large_star(links: DataFrame, n: int) -> DataFrame:
    both = links.union(links.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = lookup(both, least, ["a"], "inner", 2 * n).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a != b").distinct()


def _small_star(links: DataFrame, n: int) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = lookup(down, least, ["a"], "inner", n).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for the nodes that aren't the smallest of their component, from links (a, b) of longs."""
    links = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, drop = settle(links)
    state = None
    while True:
        n = F.count(F.lit(1)).alias("n")
        mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark")
        seen = tuple(links.agg(n, mark, F.count_distinct("a").alias("nodes")).first())
        if seen[:2] == state or seen[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = seen[:2]
        n = seen[0]  # a link gives at most one link
        following, drop_following = settle(_small_star(_large_star(links, n), n))
        drop()
        links, drop = following, drop_following
