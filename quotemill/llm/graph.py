"""Connected components as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import staged


def _written(edges: DataFrame) -> DataFrame:
    """Written with a few tasks a core: links are small, and every file of a round is read in the next."""
    return staged(edges.coalesce(2 * edges.sparkSession.sparkContext.defaultParallelism), "cc")


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, which itself hangs on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links -> ``(node, component)``, the component named by its least node.

    Alternates two steps until all links of a component lead to its least node.  "Large": every larger
    neighbour of a node is tied to the least node seen there.  "Small": every
    node and its smaller neighbours are tied to the least of them.  Each step is
    a partially aggregated ``min`` and a join, so a node with very many links
    costs one row per task in the aggregate, and AQE splits it in the join.  A path of
    n nodes takes O(log^2 n) rounds.  Every round is written to the shared
    folder.  Nodes without a link are not in the result; null ends and loops
    are ignored.
    """
    cur = _written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _settled(cur):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = (small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        cur = _written(small)
    return cur.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
