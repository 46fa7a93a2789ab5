"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm._frame import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edge list (a, b) reaches.

    Alternating large-star and small-star steps: every node links its larger neighbours, then its smaller
    ones, to the smallest of them, until each node hangs on its component's smallest. Each step is an
    aggregate and a join on narrow rows; the number of steps grows with the logarithm of the longest path.
    Nodes with self edges only are their own component. Nulls are ignored; no edges give no rows.
    """
    all_ends = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = all_ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = settle(
        all_ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct()
        )
        links = settle(small)
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31)), F.sum(F.xxhash64("b", "a") % (1 << 31))).first()
        if mark == before:
            break
        before = mark
    return nodes.join(links.select(F.col("a").alias("node"), F.col("b").alias("low")), "node", "left").select(
        "node", F.coalesce("low", "node").alias("component")
    )
