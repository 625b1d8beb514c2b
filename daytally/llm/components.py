"""Connected components of a links table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import written
from daytally.sources import files


def _large(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = links.union(links.select("b", "a")).toDF("node", "other")
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root"))
    return both.where("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("root").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of those."""
    down = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    least = down.groupBy("node").agg(F.min("other").alias("root"))
    tied = down.join(least, "node").select(F.explode(F.array("node", "other")).alias("a"), F.col("root").alias("b"))
    return tied.where("a <> b")


def _stars(links: DataFrame) -> bool:
    """Whether every node of links with a > b either is the larger end of one only, or the smaller end of all it has."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select("b", F.lit(0), F.lit(1)))
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of links (a, b); minima and joins, no lists.

    Each round is a table, so a lost executor costs one round; the one before it is removed. Rounds
    end when every link is one of a star, which takes a number of them that grows with the logarithm
    of the longest path; links that are stars already take none.
    """
    spark = links.sparkSession
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    first = links.where("a <> b").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    links, folder = written(first.distinct(), "links")
    while not _stars(links):
        links, after = written(_small(_large(links)).distinct(), "links")  # a link gives one of the large star at most
        files.remove(spark, folder)
        folder = after
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select("b", "b")).groupBy("node").agg(F.min("root").alias("root"))
