"""Connected components by alternating large-star and small-star steps.

Both steps are one aggregate and one join over the edges; nothing meets on the
driver but a count and a checksum.  Every round is written to the shared
folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import materialise


def _checksum(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum((F.xxhash64("a", "b") % (1 << 40)).cast("decimal(38,0)"))).first()


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Points every node's neighbours (the larger ones, or the smaller ones and itself) to the smallest of them."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")).withColumnRenamed("a", "_a")
    met = around.join(low, F.col("a") == F.col("_a"))
    out = met.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")) if large else met.select("b", "low").unionByName(
        met.select(F.col("a").alias("b"), "low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return out.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node with an edge; edges are (a, b) of whole numbers."""
    current = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    seen = _checksum(current)
    while True:
        current = materialise(_stars(_stars(current, large=True), large=False), "edges")
        now = _checksum(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
