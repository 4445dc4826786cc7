"""Distances, projections and geohash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .grid import cell_center, cell_of
from .scalar import ColumnLike, col, dbl, round2

# Results must agree with the published definitions.
HAVERSINE_KM = 6371.0
PROJECTION_M = 6371000.0
KM_PER_LAT_DEGREE = 111.0
KM_PER_LON_DEGREE = 85.0
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def haversine_km(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike) -> Column:
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    half_lat = F.sin((p2 - p1) / dbl(2.0))
    half_lon = F.sin(F.radians(col(lon2) - col(lon1)) / dbl(2.0))
    a = half_lat * half_lat + F.cos(p1) * F.cos(p2) * half_lon * half_lon
    return dbl(2.0 * HAVERSINE_KM) * F.atan2(F.sqrt(a), F.sqrt(dbl(1.0) - a))


def flat_km(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike, factor: float = 1.0) -> Column:
    """Flat-earth distance in km to two places; ``factor`` 0.5 gives the halved variant."""
    north = (col(lat2) - col(lat1)) * dbl(KM_PER_LAT_DEGREE)
    east = (col(lon2) - col(lon1)) * dbl(KM_PER_LON_DEGREE)
    return round2(F.hypot(north, east) * dbl(factor))


def lat_band(lat: ColumnLike) -> Column:
    """Ten-degree band counted from the south pole; the north pole itself is band 18."""
    return ((col(lat) + dbl(90.0)) / dbl(10.0)).cast("int")


def clamp(value: ColumnLike, low: float, high: float) -> Column:
    return F.greatest(dbl(low), F.least(dbl(high), col(value)))


def destination(lat: ColumnLike, lon: ColumnLike, bearing: ColumnLike, metres: ColumnLike) -> tuple[Column, Column]:
    """Point reached along a great circle."""
    angle = col(metres) / dbl(PROJECTION_M)
    theta, phi, lam = F.radians(col(bearing)), F.radians(col(lat)), F.radians(col(lon))
    sin_phi2 = F.sin(phi) * F.cos(angle) + F.cos(phi) * F.sin(angle) * F.cos(theta)
    phi2 = F.asin(sin_phi2)
    lam2 = lam + F.atan2(F.sin(theta) * F.sin(angle) * F.cos(phi), F.cos(angle) - F.sin(phi) * F.sin(phi2))
    return F.degrees(phi2), F.degrees(lam2)


def project_ahead(df: DataFrame, seconds: float, resolution: int = 9, cell: str = "cell",
                  heading: str = "heading", speed: str = "speed_mps") -> DataFrame:
    """Dead reckoning from the *cell centre* (not the reported position) to a new cell."""
    lat, lon = cell_center(cell, resolution)
    start = df.withColumns({"__lat": lat, "__lon": lon})
    ahead_lat, ahead_lon = destination("__lat", "__lon", heading, F.col(speed) * dbl(seconds))
    moved = start.withColumns({"ahead_lat": ahead_lat, "ahead_lon": ahead_lon}).drop("__lat", "__lon")
    return moved.withColumn("ahead_cell", cell_of("ahead_lat", "ahead_lon", resolution))


def _quantise(v: Column, low: float, span: float, bits: int) -> Column:
    steps = 1 << bits
    return F.least(F.floor((v - dbl(low)) / dbl(span) * dbl(float(steps))), F.lit(steps - 1)).cast("bigint")


def _letters() -> str:
    """The alphabet indexed by (bits of the leading axis, bits of the other one) instead of their interleaving."""
    out = []
    for lead in range(8):
        for other in range(4):
            code = sum(((lead >> b) & 1) << (2 * b) for b in range(3)) | sum(((other >> b) & 1) << (2 * b + 1) for b in range(2))
            out.append(GEOHASH_ALPHABET[code])
    return "".join(out)


LETTERS = _letters()


def geohash(lat: ColumnLike, lon: ColumnLike, precision: int = 6) -> Column:
    """Base-32 geohash of 1 to 12 characters.

    A letter takes three bits of one axis and two of the other, and the axes
    take turns, so each letter is one look-up in a rearranged alphabet.
    """
    bits = 5 * precision
    east_bits, north_bits = (bits + 1) // 2, bits // 2
    east = _quantise(col(lon), -180.0, 360.0, east_bits)
    north = _quantise(col(lat), -90.0, 180.0, north_bits)
    out, used = [], {"east": 0, "north": 0}
    for i in range(precision):
        take = {"east": 3, "north": 2} if i % 2 == 0 else {"east": 2, "north": 3}
        part = {}
        for axis, value, size in (("east", east, east_bits), ("north", north, north_bits)):
            used[axis] += take[axis]
            part[axis] = F.shiftright(value, size - used[axis]).bitwiseAND(F.lit((1 << take[axis]) - 1))
        lead, other = ("east", "north") if i % 2 == 0 else ("north", "east")
        out.append(F.substring(F.lit(LETTERS), (part[lead] * 4 + part[other] + 1).cast("int"), F.lit(1)))
    return F.concat(*out)
