"""Connected components of a graph given by its links, for any operator that links rows.

Large-star and small-star steps alternate: each node links its larger
neighbours, then its smaller ones, to the least node it knows, until nothing
changes.  Links and labels stay in tables on the shared folder; neither a
component nor a node's neighbours are ever gathered, only their minimum is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def connected_components(links: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """(node, component) of every node in (a, b) links of type long; the component is its least node.

    Links may repeat, stand in either direction or join a node to itself;
    nulls must not occur.  No links give no rows.  keep puts a step's rows on
    the shared folder.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, before = keep(ordered), None
    while True:
        h = F.xxhash64("a", "b")
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(20,0)"))).first()
        if mark == before or mark[0] == 0:
            return star_labels(now)
        before = mark
        now = keep(small_star(large_star(now)))


def large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = links.select("a", "b").union(links.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def star_labels(links: DataFrame) -> DataFrame:
    """Labels once every link leads to its component's least node."""
    leaves = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component")))
