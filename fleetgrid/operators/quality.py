"""Validation, filters and row-level projections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.bits import cell_resolution, h3_is_valid, hex_to_cell
from ..functions.grid import cell_center, cell_of
from ..functions.scalar import col, dbl
from ..schemas import DRIVER_RESOLUTION, MAX_SPEED_MPS, SPEED_UNITS, STATUSES, VARIANTS


def _first_failure(rules: dict[str, Column]) -> Column:
    """Name of the first rule a row fails (a null counts as a failure), else null."""
    reason = F.lit(None).cast("string")
    for name, passes in reversed(list(rules.items())):
        reason = F.when(F.coalesce(passes, F.lit(False)), reason).otherwise(F.lit(name))
    return reason


def ping_reason(driver_id: str = "driver_id", lat: str = "lat", lon: str = "lon") -> Column:
    return _first_failure({
        "blank_id": col(driver_id).rlike(r"\S"),
        "lat_range": col(lat).between(-90.0, 90.0),
        "lon_range": col(lon).between(-180.0, 180.0),
    })


def driver_reason(cell: str = "cell", heading: str = "heading", speed: str = "speed_mps") -> Column:
    return _first_failure({
        "resolution": cell_resolution(cell) == DRIVER_RESOLUTION,
        "heading": (col(heading) >= 0) & (col(heading) < 360),
        "speed": col(speed).between(0.0, MAX_SPEED_MPS),
    })


def split_by_reason(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows keep the failed rule, so nothing is lost."""
    marked = df.withColumn("reason", reason)
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


def validate_pings(df: DataFrame, on_bad: str = "quarantine") -> tuple[DataFrame, DataFrame] | DataFrame:
    """Split off bad pings, or keep every row in one table.

    ``on_bad="default"`` flags rows for partition 0, ``on_bad="reason"`` adds the
    failed rule; both judge a row once, whatever becomes of it.
    """
    if on_bad == "default":
        return df.withColumn("in_range", ping_reason().isNull())
    if on_bad == "reason":
        return df.withColumn("reason", ping_reason())
    return split_by_reason(df, ping_reason())


def validate_drivers(df: DataFrame, on_bad: str = "quarantine") -> tuple[DataFrame, DataFrame] | DataFrame:
    """Split off drivers outside their limits, or with ``on_bad="reason"`` keep every row with the failed rule."""
    if on_bad == "reason":
        return df.withColumn("reason", driver_reason())
    return split_by_reason(df, driver_reason())


def known_status(status: str = "status") -> Column:
    return col(status).isin(STATUSES)


def filter_valid_cell(df: DataFrame, cell: str = "cell") -> DataFrame:
    return df.filter(h3_is_valid(cell))


def drop_nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=cols)


def available_only(df: DataFrame, status: str = "status") -> DataFrame:
    return df.filter(col(status) == "AVAILABLE")


def with_cell(df: DataFrame, resolution: int, lat: str = "lat", lon: str = "lon", out: str = "cell") -> DataFrame:
    return df.withColumn(out, cell_of(lat, lon, resolution))


def rekey(df: DataFrame, key: str, out: str = "key") -> DataFrame:
    """Choose the key column.  Rows move only when a stateful operator needs them to."""
    return df.withColumn(out, col(key))


def with_cell_center(df: DataFrame, resolution: int, cell: str = "cell") -> DataFrame:
    lat, lon = cell_center(cell, resolution)
    return df.withColumns({"center_lat": lat, "center_lon": lon})


def with_counters(df: DataFrame, name: str | Observation, **aggregates: Column) -> DataFrame:
    """Count rows on the side while they flow past."""
    wanted = aggregates or {"rows": F.count(F.lit(1))}
    return df.observe(name, *[c.alias(k) for k, c in wanted.items()])


def counted_run(df: DataFrame, act: Callable[[DataFrame], object], **aggregates: Column) -> DataFrame:
    """Runs ``act``, which must read all of ``df`` once, and returns what was counted on the side as a row."""
    seen = Observation()
    act(with_counters(df, seen, **aggregates))
    counted = seen.get
    names = list(aggregates) or ["rows"]
    return df.sparkSession.createDataFrame([tuple(counted[n] for n in names)], ", ".join(f"`{n}` bigint" for n in names))


def normalize_pings(df: DataFrame, variant: str) -> DataFrame:
    """Bring a record variant to the common names, types and units."""
    spec = VARIANTS[variant]
    out = df.withColumnsRenamed(spec.rename)
    if spec.speed:
        name, unit = spec.speed
        out = out.withColumn("speed_mps", F.col(name).cast("double") * dbl(SPEED_UNITS[unit]))
        out = out if name == "speed_mps" else out.drop(name)
    if spec.hex_cell:
        out = out.withColumn("cell", hex_to_cell(spec.hex_cell)).drop(spec.hex_cell)
    casts = {"driver_id": "string", "lat": "double", "lon": "double", "ts_ms": "bigint",
             "heading": "double", "cell": "bigint", "step": "int"}
    return out.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in out.columns})
