"""Connected components of a stored edge table by alternating large and small stars.

Every round is two joins and two aggregations on stored tables; a node with very many edges is
combined before the shuffle in the aggregations and split by AQE in the joins. Nothing is collected
but one row of counts a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the edges (a, b) but that smallest."""
    edges = store(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "large-least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = store(large.distinct(), "large-star")  # a > b in every row
        least = store(large.groupBy("a").agg(F.min("b").alias("m")), "small-least")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = store(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "small-star")
        now = tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
        if now == before:
            return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
        before = now
