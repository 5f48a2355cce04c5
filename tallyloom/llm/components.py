"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import cut, swept


def _large(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the least node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node with an edge: root is the least node reachable.

    ``edges`` has two long columns ``a`` and ``b``, in any direction, repeats and loops
    allowed, nulls ignored. Each round only groups by node with partial sums and joins
    by node against one row a node, so a hub's edges can be split among tasks; the
    rounds grow with the logarithm of the largest component, and each is checkpointed.
    """

    def state(df: DataFrame) -> tuple:
        row = swept(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))).collect()[0]
        return row[0], row[1]

    now = cut(edges.filter("a <> b").select("a", "b"))
    before = None
    while (after := state(now)) != before and after[0]:
        before, now = after, cut(_small(_large(now)))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
