"""Copies of pings near a coarse-cell border, and their removal downstream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.grid import boundary_cells_of, cell_of, cell_parent
from ..functions.scalar import dbl
from .ordered import Cuts, Order, find_cuts, look_back
from .partitioning import salted_key

# Resolutions and ring width of the border test.
FINE, RINGS, COARSE = 9, 3, 5


def boundary_cells(df: DataFrame, fine: int = FINE, k: int = RINGS, coarse: int = COARSE) -> DataFrame:
    """Add the ping's fine cell, its primary coarse cell and every coarse cell within ``k`` rings."""
    out = df.withColumn("fine_cell", cell_of("lat", "lon", fine))
    return out.withColumns({"primary_cell": cell_parent("fine_cell", coarse, fine),
                            "coarse_cells": boundary_cells_of("fine_cell", fine, k, coarse)})


def multicast(df: DataFrame, fine: int = FINE, k: int = RINGS, coarse: int = COARSE) -> DataFrame:
    """One copy per coarse cell touched, keyed by the salted coarse cell.  Copy 0 is the primary."""
    others = F.array_except("coarse_cells", F.array("primary_cell"))
    copies = boundary_cells(df, fine, k, coarse).select(
        "*", F.posexplode(F.concat(F.array("primary_cell"), others)).alias("copy_no", "target_cell"))
    return (copies.withColumns({"is_primary": F.col("copy_no") == 0,
                                "partition_key": salted_key("target_cell", "driver_id")})
            .drop("coarse_cells"))


def mark_duplicates(df: DataFrame, order: Order = "event_id", ts: str = "ts_ms", key: str = "driver_id", cuts: Cuts | None = None) -> DataFrame:
    """Flag a row whose timestamp equals the last stored one of its driver.

    After a dropped row the stored value still equals that row's timestamp, so
    comparing with the previous arrival is the same test.
    """
    repeated = lambda w: {"duplicate": F.coalesce(F.lag(ts).over(w) == F.col(ts), F.lit(False))}
    return look_back(df, [key], order, 1, repeated, cuts=cuts)


def dedup_last(df: DataFrame, order: Order = "event_id", ts: str = "ts_ms", key: str = "driver_id",
               mode: str = "last") -> DataFrame:
    """Drop rows that repeat the last timestamp stored for their driver.

    Only the *last* timestamp is remembered, so 1, 2, 1 passes three times;
    ``mode="all_seen"`` drops every repetition instead.
    """
    if mode == "all_seen":
        return df.dropDuplicates([key, ts])
    return mark_duplicates(df, order, ts, key).filter(~F.col("duplicate")).drop("duplicate")


def boundary_stats(df: DataFrame, order: str = "event_id", fine: int = FINE, k: int = RINGS, coarse: int = COARSE) -> DataFrame:
    """Pings processed, pings near a border, extra copies sent, copies dropped again, extra copies per ping."""
    copies = multicast(df.select("driver_id", "lat", "lon", "ts_ms", order), fine, k, coarse)
    # the pings tell which drivers are large; no copy is made for that
    cuts = find_cuts(df, ["driver_id"], order)
    marked = mark_duplicates(copies.select("driver_id", "ts_ms", order, "copy_no"), [order, "copy_no"], cuts=cuts)
    sums = marked.agg(F.count_if(F.col("copy_no") == 0).alias("total_processed"),
                      F.count_if(F.col("copy_no") == 1).alias("boundary_hits"),
                      F.count_if(F.col("copy_no") > 0).alias("multicast_copies"),
                      F.count_if("duplicate").alias("dedup_drops"))
    ratio = F.when(F.col("total_processed") == 0, dbl(0.0)).otherwise(
        F.col("multicast_copies") / F.greatest(F.col("total_processed"), F.lit(1)))
    return sums.withColumn("amplification", ratio)
