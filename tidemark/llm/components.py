"""Connected components of a table of links, by alternating star steps.

A large-star step hangs every larger neighbour of a node on the node's least
neighbour, a small-star step does so with the smaller ones; both keep what is
connected, and repeated they leave a star around the least node of each
component. Links stay distributed; each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (both.where(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("m").alias("a"), "b").where(F.col("a") != F.col("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    # a < b: every b hangs its smaller neighbours, and itself, on the least of them
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    hung = links.join(least, "b")
    return (hung.select(F.col("m").alias("a"), F.col("a").alias("b"))
            .unionByName(hung.select(F.col("m").alias("a"), "b"))
            .where(F.col("a") != F.col("b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to ``node``, ``component`` for every node with a link to another.

    ``component`` is the least node that can be reached.
    """
    links = links.where(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = staged(links, "links")
    mark = _mark(links)
    while mark[0]:
        links = staged(_small_star(_large_star(links)), "stars")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
