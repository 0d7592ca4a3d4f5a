"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and a join back to the edges. The minima are dealt out
anew before the join, so that both its sides are exchanged for it: then Spark splits the node that has many neighbours.
Steps are stored in the shared folder, so lineage stays short.

Edge cases: edges of a node to itself, nulls and repeated edges say nothing; without edges there are no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import parts, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b) with a > b, distinct."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).select(F.col("a").alias("n"), "m").repartition(parts(edges))
        linked = both.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m").repartition(parts(edges))
        joined = edges.join(least, F.col("a") == F.col("n"))
        linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return linked.filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge that isn't the least of its component; edges: two columns, any order."""
    a, b = (F.col(c) for c in edges.columns)
    now = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct(), "components")
    before = None
    while True:
        now = stored(_star(_star(now, large=True), large=False), "components")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
