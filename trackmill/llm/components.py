"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.llm.work import Scratch


def components(scratch: Scratch, links: DataFrame) -> list[DataFrame]:
    """Tables (node, up), to be followed one after the other: the last `up` is the smallest node reachable.

    Links are rows (a, b), in any order and repeated or not; a link of a node to itself says
    nothing. Each node points to its smallest neighbour if that is smaller; pointers are
    followed to their ends, and the ends become the nodes of the next pass. A pass at least
    halves the groups that still have links. Every step is an aggregate or a join over rows
    of two numbers. No links give no tables.
    """
    tables = []
    links = scratch.settle(_proper(links.select("a", "b")), "links")
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        parents = parents.select("node", F.least("node", "up").alias("up"))
        while True:
            nearer = follow(follow(parents, parents, "up").withColumn("before", F.col("up")), parents, "up")
            further = scratch.settle(nearer, "parents")
            if further.filter("up != before").isEmpty():
                break
            parents = further.select("node", "up")
        parents = further.select("node", "up")
        tables.append(parents)
        shorter = scratch.settle(_proper(follow(follow(links, parents, "a"), parents, "b")), "links")
        scratch.drop(links)
        links = shorter
    scratch.drop(links)
    return tables


def _proper(links: DataFrame) -> DataFrame:
    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ends.filter("a < b").distinct()


def follow(df: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """The column replaced by its pointer, where it has one."""
    step = parents.select(F.col("node").alias("_node"), F.col("up").alias("_up"))
    moved = df.join(step, F.col(column) == F.col("_node"), "left")
    return moved.withColumn(column, F.coalesce("_up", column)).drop("_node", "_up")
