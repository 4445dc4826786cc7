"""Payload encodings: JSON, CSV, composite text keys and big-endian binary layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.binary import (get_f32, get_f64, get_i32, get_i64, get_text, get_u32, put_f32, put_f64, put_i32,
                                put_i64, put_text)
from ..functions.scalar import ColumnLike, col
from ..schemas import PING, RIDER

# Field order and types of the binary layouts.  "text" is UTF-8
# behind a 32-bit length, "pad8" is eight zero bytes.
LAYOUTS: dict[str, list[tuple[str, str]]] = {
    "fixed28": [("driver_id", "i32"), ("lat", "f64"), ("lon", "f64"), ("ts_ms", "i64")],
    "fixed40": [("ts_ms", "i64"), ("lat", "f64"), ("lon", "f64"), ("heading", "f32"), ("speed_mps", "f32"), ("", "pad8")],
    "lp_ping": [("driver_id", "text"), ("lat", "f64"), ("lon", "f64"), ("cell", "i64"), ("ts_ms", "i64")],
    "lp_rider": [("rider_id", "text"), ("lat", "f64"), ("lon", "f64"), ("cell", "i64"), ("ts_ms", "i64")],
    "lp_status": [("lat", "f64"), ("lon", "f64"), ("ts_ms", "i64"), ("status", "text"), ("driver_id", "text")],
    "lp_match": [("rider_id", "text"), ("driver_id", "text"), ("cell", "i64"), ("latency_ms", "i64")],
    "lp_key": [("entity_id", "text"), ("cell", "i64")],
}
WIDTH = {"i32": 4, "i64": 8, "f32": 4, "f64": 8, "pad8": 8}
READ = {"i32": get_i32, "i64": get_i64, "f32": get_f32, "f64": get_f64}
WRITE = {"i32": put_i32, "i64": put_i64, "f32": put_f32, "f64": put_f64, "text": put_text}
CSV_KINDS = {"ping": "driver_id STRING, lat DOUBLE, lon DOUBLE, ts_ms BIGINT, status STRING",
             "rider": "rider_id STRING, lat DOUBLE, lon DOUBLE, request_ms BIGINT"}


RAW = "__raw"


@dataclass(frozen=True)
class Decoded:
    """Every row once: its own columns, what its payload holds, and ``reason`` (null for rows that parsed), beside its raw form.

    ``rows`` reads and decodes the input once and serves both outcomes, for
    example in one write by outcome; ``good`` and ``quarantine`` are its two sides.
    """

    marked: DataFrame
    names: list[str]

    @property
    def rows(self) -> DataFrame:
        return self.marked.select(*self.names, "reason")

    @property
    def good(self) -> DataFrame:
        return self.marked.filter("reason IS NULL").select(*self.names)

    @property
    def quarantine(self) -> DataFrame:
        return self.marked.filter("reason IS NOT NULL").select(f"{RAW}.*", "reason")


def _decoded(df: DataFrame, read: DataFrame, reason: Column, kept: list[str], fields: dict[str, Column]) -> Decoded:
    """``read`` holds the columns of ``df`` and what ``reason`` and ``fields`` are made of; fields of bad rows are null."""
    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(RAW)
    judged = read.withColumn("__reason", reason)
    good = F.col("__reason").isNull()
    found = [F.when(good, column).alias(name) for name, column in fields.items()]
    return Decoded(judged.select(*kept, *found, F.col("__reason").alias("reason"), raw), [*kept, *fields])


def encode_binary(df: DataFrame, layout: str, out: str = "value") -> DataFrame:
    parts = [F.lit(bytes(8)) if kind == "pad8" else WRITE[kind](F.col(name)) for name, kind in LAYOUTS[layout]]
    return df.withColumn(out, F.concat(*parts))


def decode_binary(df: DataFrame, layout: str, value: str = "value") -> Decoded:
    """Decode by layout.  A payload of the wrong length goes to the quarantine whole.

    Offsets behind a text field depend on its length, so each length is read
    into a column of its own once and later offsets are sums of columns.
    """
    out, start, names = df, F.lit(1), []
    for i, (name, kind) in enumerate(LAYOUTS[layout]):
        if kind == "text":
            length = f"__len{i}"
            out = out.withColumn(length, F.least(get_u32(value, start), F.octet_length(value).cast("bigint")))
            names.append((name, kind, start + 4, F.col(length)))
            start = start + 4 + F.col(length)
        else:
            if name:
                names.append((name, kind, start, None))
            start = start + WIDTH[kind]
    # a cut, negative or oversized length never adds up to the payload's size
    fits = F.octet_length(value) == start - 1
    fields = {name: get_text(value, at, size) if kind == "text" else READ[kind](value, at) for name, kind, at, size in names}
    kept = [c for c in df.columns if c != value and c not in fields]
    return _decoded(df, out, F.when(~F.coalesce(fits, F.lit(False)), "length"), kept, fields)


def encode_csv(kind: str) -> Column:
    """``id,lat,lon,ts[,status]`` with six decimals for the coordinates."""
    if kind == "rider":
        return F.format_string("%s,%.6f,%.6f,%d", "rider_id", "lat", "lon", "request_ms")
    return F.format_string("%s,%.6f,%.6f,%d,%s", "driver_id", "lat", "lon", "ts_ms", F.coalesce("status", F.lit("")))


def decode_csv(df: DataFrame, kind: str, value: str = "value") -> Decoded:
    schema = f"{CSV_KINDS[kind]}, _corrupt_record STRING"
    parsed = df.withColumn("__row", F.from_csv(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    return _split(df, parsed, value)


def encode_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def decode_json(df: DataFrame, schema: T.StructType = PING, value: str = "value") -> Decoded:
    """Parse a JSON object per row.  Rows that do not parse are kept in the quarantine, not skipped."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = df.withColumn("__row", F.from_json(value, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    return _split(df, parsed, value)


def _split(df: DataFrame, parsed: DataFrame, value: str) -> Decoded:
    bad = F.col("__row").isNull() | F.col("__row._corrupt_record").isNotNull()
    names = [f.name for f in parsed.schema["__row"].dataType.fields if f.name != "_corrupt_record"]
    kept = [c for c in df.columns if c != value and c not in names]
    return _decoded(df, parsed, F.when(bad, "unparsable"), kept, {n: F.col("__row")[n] for n in names})


def composite_key(entity: ColumnLike, lat: ColumnLike, lon: ColumnLike) -> Column:
    return F.concat_ws("|", col(entity), col(lat).cast("string"), col(lon).cast("string"))


def parse_composite_key(df: DataFrame, key: str = "key") -> Decoded:
    """``<entity>|<lat>|<lon>``: exactly three parts with numeric coordinates, else quarantine."""
    parts = F.split(key, "\\|", 3)
    read = df.withColumns({
        "__parts": parts,
        "__lat": F.when(F.size(parts) == 3, F.get(parts, F.lit(1)).try_cast("double")),
        "__lon": F.when(F.size(parts) == 3, F.get(parts, F.lit(2)).try_cast("double"))})
    reason = (F.when(F.col(key).isNull(), "null_key").when(F.size("__parts") != 3, "parts")
              .when(F.col("__lat").isNull() | F.col("__lon").isNull(), "number"))
    fields = {"entity_id": F.get("__parts", F.lit(0)), "lat": F.col("__lat"), "lon": F.col("__lon")}
    return _decoded(df, read, reason, [c for c in df.columns if c not in fields], fields)


__all__ = ["LAYOUTS", "Decoded", "encode_binary", "decode_binary", "encode_csv", "decode_csv", "encode_json",
           "decode_json", "composite_key", "parse_composite_key", "PING", "RIDER"]
