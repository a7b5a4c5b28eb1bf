"""Connected components of a table of links by contraction; every round is a written table.

In a round every node takes the least of itself and its neighbours, follows that once, and the links are drawn anew
between what was taken. The least node of a component always takes itself, so it is what remains. A star is gone after
one round, and every round leaves at most half of the nodes of a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.llm.common import written


def _undirected(links: DataFrame) -> DataFrame:
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.where("a <> b").distinct()


def _named(roots: DataFrame, node: str, root: str) -> DataFrame:
    return roots.select(F.col("node").alias(node), F.col("root").alias(root))


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root): the least node that links (a, b) reach; nodes without links are not listed."""
    links = written(spark, _undirected(links), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        taken = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        taken = taken.select("node", F.least("node", "low").alias("root"))
        followed = taken.join(_named(taken, "root", "beyond"), "root").select("node", F.col("beyond").alias("root"))
        followed = written(spark, followed, "taken")
        if roots is None:
            roots = followed
        else:
            above = roots.join(_named(followed, "root", "beyond"), "root", "left")
            roots = written(spark, above.select("node", F.coalesce("beyond", "root").alias("root")), "roots")
        between = links.join(_named(followed, "a", "root_a"), "a").join(_named(followed, "b", "root_b"), "b")
        links = written(spark, _undirected(between.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))), "links")
        if links.isEmpty():
            return roots


def extended(spark: SparkSession, roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``roots`` after more links (a, b): only the roots that the links join are worked on."""
    between = links.join(_named(roots, "a", "root_a"), "a", "left").join(_named(roots, "b", "root_b"), "b", "left")
    between = between.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    joined = components(spark, between)
    if joined.isEmpty():
        return roots
    above = roots.join(_named(joined, "root", "beyond"), "root", "left")
    fresh = joined.join(roots.select("node"), "node", "left_anti")
    return written(spark, above.select("node", F.coalesce("beyond", "root").alias("root")).unionByName(fresh), "roots")
