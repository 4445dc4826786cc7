"""Small scalar helpers shared by every module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(value: float) -> Column:
    return F.lit(float(value)).cast("double")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out before they multiply; a fixed number of partitions, because re-planning would merge the few rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def deal(df: DataFrame) -> DataFrame:
    """The same in turn, whatever the rows hold: rows that are alike do not meet in one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def half_up(x: ColumnLike, places: int) -> Column:
    """Round half up with plain arithmetic, so every engine gives the same double."""
    scale = dbl(10.0**places)
    return F.floor(col(x).cast("double") * scale + dbl(0.5)) / scale


def round2(x: ColumnLike) -> Column:
    """Two decimal places, halves upwards."""
    return half_up(x, 2)


def latency_ms(now_ms: ColumnLike, ts_ms: ColumnLike) -> Column:
    """Age of an event.  The clock is an argument: wall-clock time cannot be replayed."""
    return col(now_ms).cast("bigint") - col(ts_ms).cast("bigint")


def padded_id(n: ColumnLike, prefix: str = "driver-", width: int = 5) -> Column:
    return F.format_string(f"{prefix}%0{width}d", col(n))


def epoch_millis(ts: ColumnLike) -> Column:
    """Milliseconds since 1970, read off the wall-clock fields (no session time zone)."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            col(ts).cast("timestamp_ntz"))


def shift_left(value: Column, places: Column) -> Column:
    """Shift by a number of places that is itself a column."""
    return F.call_function("shiftleft", value, places.cast("int"))
