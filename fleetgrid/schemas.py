"""The common ping and rider shapes, and how each record variant maps onto them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

PING = T.StructType([
    T.StructField("driver_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("status", T.StringType()),
])

RIDER = T.StructType([
    T.StructField("rider_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("request_ms", T.LongType()),
])

# The statuses a ping may carry, and the limits a driver must respect.
STATUSES = ["AVAILABLE", "EN_ROUTE_TO_PICKUP", "ON_TRIP", "OFFLINE"]
DRIVER_RESOLUTION = 9
MAX_SPEED_MPS = 33.3

# Speed units to metres per second.
SPEED_UNITS = {"mps": 1.0, "kmh": 1.0 / 3.6, "mph": 0.44704}


@dataclass(frozen=True)
class Variant:
    """How one producer names its fields."""

    rename: dict[str, str] = field(default_factory=dict)
    speed: tuple[str, str] | None = None
    hex_cell: str | None = None


# Field names used by the record variants.
VARIANTS = {
    "plain": Variant({"driverId": "driver_id", "latitude": "lat", "longitude": "lon", "timestamp": "ts_ms"}),
    "snake": Variant({"latitude": "lat", "longitude": "lon", "timestamp": "ts_ms", "h3_index": "cell"}),
    "short": Variant({"driverId": "driver_id", "lng": "lon", "timestampMs": "ts_ms", "h3Cell": "cell"}),
    "hex": Variant({"driverId": "driver_id", "timestampMs": "ts_ms"}, hex_cell="h3Cell"),
    "kinematic_mps": Variant({"driverId": "driver_id", "timestampMs": "ts_ms", "headingDegrees": "heading"},
                             speed=("speedMps", "mps")),
    "kinematic_kmh": Variant({"driverId": "driver_id", "latitude": "lat", "longitude": "lon", "timestamp": "ts_ms"},
                             speed=("speedKmh", "kmh")),
    "kinematic_mph": Variant({"driverId": "driver_id", "latitude": "lat", "longitude": "lon", "timestamp": "ts_ms"},
                             speed=("speed", "mph")),
    "seeded": Variant({"driverId": "driver_id", "lng": "lon", "eventTimestamp": "ts_ms"}),
    "step": Variant({"entityId": "driver_id", "h3Index": "cell", "timestamp": "ts_ms", "stepNumber": "step"}),
    "city": Variant({"driverId": "driver_id", "timestamp": "ts_ms", "cityName": "city"}),
}
