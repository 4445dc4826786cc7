"""Matching riders to drivers that share a cell, and co-location checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import ColumnLike, latency_ms
from .ordered import Order, running
from .state import latest_by


def match_same_cell(riders: DataFrame, pings: DataFrame, order: str = "event_id", available: str | None = "after",
                    now_ms: ColumnLike | None = None) -> DataFrame:
    """Inner join of riders with the last driver that wrote to their cell.

    ``available="after"`` tests availability on that last writer, so an OFFLINE
    ping hides an earlier AVAILABLE driver.  ``"before"`` looks for the last
    AVAILABLE writer instead; ``None`` does not test at all.

    The driver side has one row per cell, so the join never multiplies riders;
    a cell with very many riders is split at run time by the skew join.
    """
    wanted = pings.select("cell", "driver_id", "status", order)
    if available == "before":
        wanted = wanted.filter(F.col("status") == "AVAILABLE")
    table = latest_by(wanted, ["cell"], order).withColumnRenamed(order, "driver_order")
    matched = riders.join(table, "cell")
    if available == "after":
        matched = matched.filter(F.col("status") == "AVAILABLE")
    out = [F.col("rider_id"), F.col("driver_id"), F.col("cell")]
    if now_ms is not None:
        out.append(latency_ms(now_ms, "request_ms").alias("latency_ms"))
    return matched.select(*out)


def tag_union(riders: DataFrame, pings: DataFrame, rider_arrival: str, ping_arrival: str) -> DataFrame:
    """Drivers and riders of every cell in one table or stream, with a common arrival number."""
    a = pings.select("cell", F.lit("driver").alias("kind"), F.col(ping_arrival).cast("bigint").alias("arrival"),
                     "driver_id", "status", F.lit(None).cast("string").alias("rider_id"))
    b = riders.select("cell", F.lit("rider").alias("kind"), F.col(rider_arrival).cast("bigint").alias("arrival"),
                      F.lit(None).cast("string").alias("driver_id"), F.lit(None).cast("string").alias("status"), "rider_id")
    return a.unionByName(b)


def match_as_of(union: DataFrame, available: bool = True, order: Order = "arrival") -> DataFrame:
    """Riders meet the last driver that wrote to their cell *before they arrived*.

    This is the same-cell match with the table seen as it was at each request,
    over the rows of ``tag_union``.  A crowded cell is scanned in parts.
    """
    along = [*([order] if isinstance(order, str) else order), "kind"]
    driver = F.when(F.col("kind") == "driver", F.struct(*along[:-1], "driver_id", "status"))
    seen = running(union.withColumn("__driver", driver), ["cell"], along, "__driver", "max", "__now")
    matched = seen.filter((F.col("kind") == "rider") & F.col("__now").isNotNull())
    if available:
        matched = matched.filter(F.col("__now.status") == "AVAILABLE")
    return matched.select("rider_id", F.col("__now.driver_id").alias("driver_id"), "cell", "arrival")


def copartition_check(a: DataFrame, b: DataFrame, n_a: int, n_b: int, cell: str = "cell",
                      partition: str = "partition") -> DataFrame:
    """Per cell: the partitions used by each side, and whether a local join would find both.

    Aligned means each side keeps the cell in one partition, both name the same
    one, and both have equally many partitions.
    """

    def placed(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(cell).agg(F.min(partition).alias(f"{name}_first"), F.max(partition).alias(f"{name}_last"))

    both = placed(a, "a").join(placed(b, "b"), cell, "full_outer")
    one_each = (F.col("a_first") == F.col("a_last")) & (F.col("b_first") == F.col("b_last"))
    same = one_each & (F.col("a_first") == F.col("b_first")) & F.lit(n_a == n_b)
    present = F.col("a_first").isNotNull() & F.col("b_first").isNotNull()
    side = F.when(present, "both").when(F.col("a_first").isNotNull(), "a").otherwise("b")
    return both.select(cell, side.alias("side"), F.col("a_first").alias("a_partition"),
                       F.col("b_first").alias("b_partition"),
                       F.when(present, same).alias("aligned"))


def copartition_summary(check: DataFrame) -> DataFrame:
    """Counts of aligned, misaligned and one-sided cells."""

    def count_of(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    return check.agg(F.count(F.lit(1)).alias("cells"), count_of(F.col("aligned")).alias("aligned"),
                     count_of(~F.col("aligned")).alias("misaligned"),
                     count_of(F.col("aligned").isNull()).alias("one_sided"))


def top1(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group in ``order``; every map task sends one candidate per group."""
    others = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("__best"))
    return best.select(*by, "__best.*")
