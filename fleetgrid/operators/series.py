"""Rates, moving means, breaches, cell transitions and step numbers along ordered series."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.grid import axial_q, axial_r, pack_cell, round_axial
from ..functions.scalar import dbl
from .ordered import Build, Order, look_back, looked_back, number_rows, series, since_reset

# Fixed values of the soak gate.
RATE_FLOOR, STREAK_LIMIT, SAMPLE_MS = 0.92, 3, 10_000
DAY_MS = 86_400_000
NUDGE = 1e-6


def _rate(ts_ms: str, value: str, min_dt: float, fixed_seconds: int | None, rounded: Callable[[Column], Column]) -> Build:
    def build(w) -> dict[str, Column]:
        before = F.lag(value).over(w)
        if fixed_seconds:
            step = F.col(value).cast("bigint") - F.coalesce(before.cast("bigint"), F.lit(0))
            return {"rate": (F.sign(step) * F.floor(F.abs(step) / fixed_seconds)).cast("bigint")}
        dt = (F.col(ts_ms) - F.lag(ts_ms).over(w)) / dbl(1000.0)
        rate = (F.col(value) - before) / dt
        return {"rate": rounded(F.when(dt > min_dt, rate).otherwise(dbl(0.0)))}

    return build


def _mean(value: str, n: int) -> Build:
    return lambda w: {"moving_avg": F.avg(value).over(w.rowsBetween(-(n - 1), 0))}


def counter_rate(df: DataFrame, keys: list[str], order: Order, ts_ms: str = "ts_ms", value: str = "value",
                 min_dt: float = 0.5, fixed_seconds: int | None = None) -> DataFrame:
    """Turn a growing counter into a rate.

    0 for the first sample and when no more than ``min_dt`` seconds have passed.
    ``fixed_seconds`` divides by a fixed interval with integer division instead,
    counting the first sample from zero.
    """
    return look_back(df, keys, order, 1, _rate(ts_ms, value, min_dt, fixed_seconds, lambda rate: rate))


def moving_avg(df: DataFrame, keys: list[str], order: Order, value: str = "rate", n: int = 10) -> DataFrame:
    """Mean of the last ``n`` values, the current one included."""
    return look_back(df, keys, order, n - 1, _mean(value, n))


def moving_rate(df: DataFrame, keys: list[str], order: Order, ts_ms: str = "ts_ms", value: str = "value", n: int = 10,
                min_dt: float = 0.5, rounded: Callable[[Column], Column] = lambda rate: rate) -> DataFrame:
    """``counter_rate``, rounded as told, and the mean of its last ``n`` values, from one dealing of the rows."""
    return look_back(df, keys, order, n, _rate(ts_ms, value, min_dt, None, rounded), _mean("rate", n))


def throughput(df: DataFrame, every: str, ts: str = "event_ts", watermark: str | None = None) -> DataFrame:
    """Rows per fixed interval of event time; works on tables and on streams."""
    base = df.withWatermark(ts, watermark) if watermark else df
    return (base.groupBy(F.window(ts, every)).agg(F.count(F.lit(1)).alias("records"))
            .select(F.col("window.start").alias("window_start"), "records"))


def sample_counts(df: DataFrame, ts_ms: str = "ts_ms", every_ms: int = SAMPLE_MS) -> DataFrame:
    """Rows per sample interval, with the empty intervals in between counted as 0.

    The gaps are filled from the intervals themselves: each interval also names
    how many empty ones follow it.
    """
    counted = df.groupBy(F.floor(F.col(ts_ms) / every_ms).alias("sample")).agg(F.count(F.lit(1)).alias("records"))
    reach = counted.agg(F.min("sample").alias("first"), F.max("sample").alias("last"))
    # hand out whole days first, so that no single task lists all samples
    per_day = DAY_MS // every_ms
    days = reach.select("first", "last", F.explode(F.sequence(F.floor(F.col("first") / per_day),
                                                               F.floor(F.col("last") / per_day))).alias("day"))
    spread = days.repartition("day")
    every = spread.select(F.explode(F.sequence(F.greatest(F.col("day") * per_day, F.col("first")),
                                               F.least((F.col("day") + 1) * per_day - 1, F.col("last")))).alias("sample"))
    return every.join(counted, "sample", "left").select("sample", F.coalesce("records", F.lit(0)).alias("records"))


def sustained_breach(samples: DataFrame, target: float, floor: float = RATE_FLOOR, limit: int = STREAK_LIMIT,
                     every_ms: int = SAMPLE_MS) -> DataFrame:
    """Length of the current run of slow samples, and whether it has reached ``limit``.

    A sample is judged only when the one before it was not empty; a fast judged
    sample ends the run and an unjudged one leaves it as it is.
    """
    share = F.col("records") / dbl(every_ms / 1000.0) / dbl(target)
    dealt = series(samples.withColumn("rate_share", share), [], "sample")
    known = looked_back(dealt, 1, lambda w: {"__before": F.lag("records").over(w)})
    judged = F.coalesce(F.col("__before") > 0, F.lit(False))
    slow = judged & (F.col("rate_share") < floor)
    marked = replace(known, rows=known.rows.withColumns({"judged": judged, "__slow": slow.cast("bigint"), "__ends": judged & ~slow}))
    streaks = since_reset(marked, "__slow", "__ends", "streak").rows
    return streaks.select("sample", "records", "rate_share", "judged", "streak", (F.col("streak") >= limit).alias("breach"))


def step_number(df: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """Steps of each history, from 0."""
    numbered = number_rows(df, keys, order, "__n")
    return numbered.withColumn("step", F.col("__n") - 1).drop("__n")


def cell_transitions(df: DataFrame, resolution: int, order: Order = "event_id", key: str = "driver_id",
                     ts_ms: str = "ts_ms", cell: str = "cell", fill_gaps: bool = True) -> DataFrame:
    """A row whenever a driver enters a cell; cells skipped between two pings are filled in.

    Skipped cells lie on the straight line and get evenly spaced times and
    ``interpolated = true``.
    """
    earlier = lambda w: {"__cell": F.lag(cell).over(w), "__ts": F.lag(ts_ms).over(w)}
    columns = [key, ts_ms, cell, *([order] if isinstance(order, str) else order)]
    moved = (look_back(df.select(*dict.fromkeys(columns)), [key], order, 1, earlier)
             .filter(F.col("__cell").isNull() | (F.col("__cell") != F.col(cell))))
    start, end = F.col("__cell"), F.col(cell)
    line = moved.withColumns({
        "__q": axial_q(start).cast("double"), "__r": axial_r(start).cast("double"),
        "__dq": (axial_q(end) - axial_q(start)).cast("double"), "__dr": (axial_r(end) - axial_r(start)).cast("double")})
    steps = ((F.abs("__dq") + F.abs("__dr") + F.abs(F.col("__dq") + F.col("__dr"))) / dbl(2.0)).cast("int")
    line = line.withColumn("__steps", F.coalesce(steps, F.lit(1)) if fill_gaps else F.lit(1))
    # one row per step along the line; the last one is the ping itself
    walked = line.withColumn("__i", F.explode(F.sequence(F.lit(1), "__steps")))
    share = F.col("__i").cast("double") / F.col("__steps").cast("double")
    walked = walked.withColumns({"__share": share, "__there": F.col("__i") == F.col("__steps")})
    between = pack_cell(*round_axial(F.col("__q") + dbl(NUDGE) + F.col("__dq") * F.col("__share"),
                                     F.col("__r") + dbl(2.0 * NUDGE) + F.col("__dr") * F.col("__share")), resolution)
    when = F.col("__ts") + F.floor((F.col(ts_ms) - F.col("__ts")) * F.col("__share"))
    return walked.select(key, F.when(F.col("__there"), F.col(ts_ms)).otherwise(when).alias("timestamp"),
                         F.when(F.col("__there"), end).otherwise(between).alias("current_cell"),
                         (~F.col("__there")).alias("interpolated"))


def transition_rate(df: DataFrame, order: Order = "event_id", key: str = "driver_id", ts_ms: str = "ts_ms",
                    cell: str = "cell") -> DataFrame:
    """Cell changes per driver-second over the whole fleet."""
    changed = lambda w: {"__changed": F.coalesce(F.lag(cell).over(w) != F.col(cell), F.lit(False))}
    columns = [key, ts_ms, cell, *([order] if isinstance(order, str) else order)]
    marked = look_back(df.select(*dict.fromkeys(columns)), [key], order, 1, changed)
    per_driver = marked.groupBy(key).agg(F.count_if("__changed").alias("changes"),
                                         (F.max(ts_ms) - F.min(ts_ms)).alias("span_ms"))
    sums = per_driver.agg(F.coalesce(F.sum("changes"), F.lit(0)).alias("transitions"),
                          F.coalesce(F.sum("span_ms"), F.lit(0)).alias("driver_ms"))
    rate = F.when(F.col("driver_ms") > 0, F.col("transitions") * dbl(1000.0) / F.greatest("driver_ms", F.lit(1))).otherwise(dbl(0.0))
    return sums.withColumn("per_driver_second", rate)

