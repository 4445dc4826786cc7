"""Partition numbers from cells, keys and payloads, and placement by number.

A mode is one published formula.  Signed hashes make ``abs`` and ``floor``
remainders differ, so the two are never interchanged.  Rows a formula rejects
get a null partition and can be set aside; no row is ever placed at random.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binary import get_f64, get_i64
from ..functions.bits import h3_parent, hex_to_cell
from ..functions.geo import geohash
from ..functions.grid import cell_of
from ..functions.hashing import bytes_hash, fold32, java_hash, murmur2, signed32
from ..functions.scalar import ColumnLike, col

SUB_SHARDS = 8
CITY_PARTITIONS = 60


def _abs_mod(hashed: Column, n: int) -> Column:
    return F.abs(hashed.cast("bigint")) % n


def _in_range(lat: Column, lon: Column) -> Column:
    return lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def _string_mod(text: Column, n: int) -> Column:
    return _abs_mod(signed32(java_hash(text)), n)


def _mod(n: int, cell: ColumnLike = "cell") -> Column:
    return F.abs(col(cell)) % n


def _mod_abs(n: int, cell: ColumnLike = "cell") -> Column:
    return F.abs(col(cell) % n)


def _fold_abs(n: int, cell: ColumnLike = "cell") -> Column:
    return _abs_mod(fold32(cell), n)


def _geohash(n: int, lat: ColumnLike = "lat", lon: ColumnLike = "lon") -> Column:
    ok = _in_range(col(lat), col(lon))
    return F.when(ok, _string_mod(geohash(lat, lon, 6), n)).otherwise(F.lit(0))


def _res9_mod(n: int, lat: ColumnLike = "lat", lon: ColumnLike = "lon") -> Column:
    ok = _in_range(col(lat), col(lon))
    return F.when(ok, F.abs(cell_of(lat, lon, 9)) % n).otherwise(F.lit(0))


def _json_mod(n: int, payload: ColumnLike = "payload", path: str = "$.h3Cell") -> Column:
    # try_cast: a missing or non-numeric cell rejects the row
    return F.abs(F.get_json_object(col(payload), path).try_cast("bigint") % n)


def _hex_fold_floor(n: int, hexed: ColumnLike = "cell_hex") -> Column:
    return F.pmod(fold32(hex_to_cell(hexed)), F.lit(n))


def _res6_fold(n: int, key: ColumnLike = "key", fallback: ColumnLike = "key_text") -> Column:
    eight = F.octet_length(col(key)) == 8
    return F.when(eight, _abs_mod(fold32(get_i64(key, 1)), n)).otherwise(_string_mod(col(fallback), n))


def _res3_unsigned(n: int, value: ColumnLike = "value", key: ColumnLike = "key") -> Column:
    lat, lon = get_f64(value, 1), get_f64(value, 9)
    hashed_key = F.when(col(key).isNull(), F.lit(0)).otherwise(_abs_mod(signed32(bytes_hash(key)), n))
    short = col(value).isNull() | (F.octet_length(col(value)) < 16)
    return (F.when(short, hashed_key)
            .when(_in_range(lat, lon), F.pmod(cell_of(lat, lon, 3), F.lit(n)))
            .otherwise(F.lit(0)))


def _parent3_fold(n: int, key: ColumnLike = "key", value: ColumnLike = "value") -> Column:
    eight = F.coalesce(F.octet_length(col(key)) == 8, F.lit(False))
    folded = _abs_mod(fold32(h3_parent(get_i64(key, 1), 3)), n)
    body = F.coalesce(col(value), F.lit(b""))
    return F.when(eight, folded).otherwise(murmur2(body).bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint")) % n)


def _res4_fold_floor(n: int, lat: ColumnLike = "lat", lon: ColumnLike = "lon") -> Column:
    return F.pmod(fold32(cell_of(lat, lon, 4)), F.lit(n))


def _default(n: int, key_text: ColumnLike = "key_text") -> Column:
    hashed = murmur2(F.encode(col(key_text), "UTF-8"))
    return hashed.bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint")) % n


MODES: dict[str, Callable[..., Column]] = {
    "mod": _mod,
    "fold_abs": _fold_abs,
    "geohash": _geohash,
    "res9_mod": _res9_mod,
    "mod_abs": _mod_abs,
    "json_mod": _json_mod,
    "hex_fold_floor": _hex_fold_floor,
    "res6_fold": _res6_fold,
    "res3_unsigned": _res3_unsigned,
    "parent3_fold": _parent3_fold,
    "res4_fold_floor": _res4_fold_floor,
    "default": _default,
}


def partition_of(mode: str, n: int, **inputs: ColumnLike) -> Column:
    """The partition number (0..n-1) under ``mode``; null where the formula rejects the row."""
    return MODES[mode](n, **inputs).cast("int")


def assign_partition(df: DataFrame, mode: str, n: int, out: str = "partition", **inputs: ColumnLike) -> DataFrame:
    return df.withColumn(out, partition_of(mode, n, **inputs))


def place_by_partition(df: DataFrame, n: int, partition: str = "partition") -> DataFrame:
    """Move each row to exactly the Spark partition its number names."""
    return df.repartitionById(n, partition)


def sub_shard(driver_id: ColumnLike, shards: int = SUB_SHARDS) -> Column:
    return _string_mod(col(driver_id), shards).cast("int")


def salted_key(cell: ColumnLike, driver_id: ColumnLike, shards: int = SUB_SHARDS) -> Column:
    """``<cell>|<sub-shard>``: spreads one hot cell over ``shards`` keys."""
    return F.concat_ws("|", col(cell).cast("string"), sub_shard(driver_id, shards).cast("string"))

