"""Latest-value tables.

"Latest" follows arrival, which a table does not record by itself, so every
operator takes an explicit arrival column whose values are unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DataType, DecimalType, NumericType, BooleanType, TimestampNTZType, TimestampType, DateType

FIXED_WIDTH = (NumericType, BooleanType, TimestampType, TimestampNTZType, DateType)


def _fixed_width(kind: DataType) -> bool:
    return isinstance(kind, FIXED_WIDTH) and not isinstance(kind, DecimalType)


def latest_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row to arrive for each key, all columns kept.

    Each map task sends at most one row per key, so a key that holds a third of
    the input costs no more than any other.  Fixed-width columns are taken one
    by one, which keeps the aggregate hash-based.  With text columns only the
    last arrival of each key is aggregated, and a semi-join then fetches the rows
    that arrived then: one for each key, so the window over them, which settles
    arrival numbers that were used twice, is small.  No text is sorted or
    aggregated.  A row without an arrival number has not arrived and is left out.
    """
    df = df.filter(F.col(order).isNotNull())
    others = [f for f in df.schema.fields if f.name not in keys and f.name != order]
    if all(_fixed_width(f.dataType) for f in others):
        picked = [F.max_by(f.name, order).alias(f.name) for f in others]
        out = df.groupBy(*keys).agg(*picked, F.max(order).alias(order))
    else:
        last = df.groupBy(*keys).agg(F.max(order).alias(order)).select(order)
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
        out = df.join(last, order, "left_semi").withColumn("__rank", rank).filter("__rank = 1")
    return out.select(*df.columns)


def latest_per_cell_driver(df: DataFrame, order: str, evict_moved: bool = False) -> DataFrame:
    """Latest row per (cell, driver).

    By default a driver who moved on stays listed in the old cell as well;
    ``evict_moved`` keeps only the cell of the driver's last ping.
    """
    keys = ["driver_id"] if evict_moved else ["cell", "driver_id"]
    return latest_by(df, keys, order)


def driver_cells(df: DataFrame, order: str) -> DataFrame:
    """driver -> current cell."""
    return latest_by(df.select("driver_id", "cell", order), ["driver_id"], order).select("driver_id", "cell")


def lookup(state: DataFrame, driver_id: str) -> DataFrame:
    """One driver's state; empty when unknown.  The filter reaches the scan of a written state table."""
    return state.filter(F.col("driver_id") == driver_id)
