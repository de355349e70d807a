"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import settled


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node's neighbours are linked to the smallest of them and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("__a"), F.least("a", "m").alias("m"))
    # the frame with the many rows is the left side, so that a node with many links can be split
    linked = both.join(least, F.col("a") == F.col("__a"))
    if large:
        return linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    inner = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.union(least.select(F.col("__a").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links of longs → (node, root): root is the smallest node reachable; roots aren't listed.

    Every round is written to the shared folder; rounds end when one changes nothing.
    """
    now = settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    seen = None
    while True:
        now = settled(_star(_star(now, True), False), "links")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
