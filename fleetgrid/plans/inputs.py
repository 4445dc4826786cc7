"""Pings, riders and cell ids derived from the given tables.

Coordinates come from integer arithmetic on the ids, so that Spark and any SQL
engine compute identical doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.bits import ONE_PER_DIGIT
from ..functions.grid import wrapped_longitude
from ..functions.scalar import dbl, epoch_millis, shift_left

# The bounding box the coordinates are spread over, and its primes.
LAT0, LAT_SPAN = 40.4774, 0.4402
LON0, LON_SPAN = -74.2591, 0.5588
START_MS = 1704067200000
MONTH_S = 2592000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _share(number: Column, modulus: int) -> Column:
    return (number % modulus).cast("double") / dbl(modulus)


def status_of(event_type: str = "event_type") -> Column:
    kind = F.col(event_type)
    return F.when(kind == "error", "OFFLINE").when(kind == "purchase", "ON_TRIP").otherwise("AVAILABLE")


def ping_columns(events: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return events.select(
        e, u, F.concat(F.lit("driver-"), u.cast("string")).alias("driver_id"),
        (dbl(LAT0) + dbl(LAT_SPAN) * _share(e * 7919 + u * 104729, 10007)).alias("lat"),
        (dbl(LON0) + dbl(LON_SPAN) * _share(e * 6101 + u * 15485863, 10009)).alias("lon"),
        epoch_millis("ts").alias("ts_ms"), F.col("ts").alias("event_ts"), status_of().alias("status"))


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver pings; arrival order is event_id."""
    return ping_columns(table(spark, sf_dir, "events"))


def world_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pings spread from 85 south to 85 north and all the way round."""
    e, u = F.col("event_id"), F.col("user_id")
    return pings(spark, sf_dir).withColumns({
        "lat": dbl(-85.0) + dbl(170.0) * _share(e * 7919 + u * 104729, 10007),
        "lon": dbl(-180.0) + dbl(360.0) * _share(e * 6101 + u * 15485863, 10009)})


SEAM_SHIFT = 253.9797  # degrees east that take the middle of the area to the antimeridian


def at_seam(rows: DataFrame) -> DataFrame:
    """The same rows with their area moved onto the antimeridian."""
    return rows.withColumn("lon", wrapped_longitude(F.col("lon") + dbl(SEAM_SHIFT)))


def flawed_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings in which some ids are blank and some coordinates are out of range."""
    e = F.col("event_id")
    return pings(spark, sf_dir).withColumns({
        "driver_id": F.when(e % 97 == 0, F.lit("  ")).otherwise(F.col("driver_id")),
        "lat": F.when(e % 89 == 0, dbl(95.0)).otherwise(F.col("lat")),
        "lon": F.when(e % 83 == 0, dbl(-181.0)).otherwise(F.col("lon"))})


def riders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        o.alias("order_id"), F.concat(F.lit("rider-"), o.cast("string")).alias("rider_id"),
        (dbl(LAT0) + dbl(LAT_SPAN) * _share(o * 6007 + c * 7561, 10037)).alias("lat"),
        (dbl(LON0) + dbl(LON_SPAN) * _share(o * 4903 + c * 9811, 10039)).alias("lon"),
        (F.lit(START_MS) + ((o * 86413) % MONTH_S) * 1000).alias("request_ms"))


def h3_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3-shaped ids of every resolution, a good part of them broken in some way."""
    return as_h3_ids(pings(spark, sf_dir))


def as_h3_ids(pings_: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    res = (e % 16).cast("bigint")
    random = ((e % 1000003) * 2654435761 + u * 40503) % (1 << 45)
    sevens = random.bitwiseAND(F.shiftright(random, 1)).bitwiseAND(F.shiftright(random, 2)).bitwiseAND(F.lit(ONE_PER_DIGIT))
    digits = F.when(u % 5 == 0, random).otherwise(random - sevens)
    unused = shift_left(F.lit(1).cast("bigint"), F.lit(45) - res * 3) - 1
    mode = F.when(e % 11 == 0, F.lit(2)).otherwise(F.lit(1)).cast("bigint")
    cell = (F.shiftleft(mode, 59).bitwiseOR(F.shiftleft(res, 52)).bitwiseOR(F.shiftleft(u % 125, 45))
            .bitwiseOR(digits).bitwiseOR(unused))
    return pings_.withColumn("cell", cell)


def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per order: codec, payload, outcome and latency."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    codec = F.element_at(F.array(*[F.lit(v) for v in ("none", "lz4", "snappy", "gzip")]), (o % 4 + 1).cast("int"))
    payload = F.to_json(F.struct(F.concat(F.lit("driver-"), c.cast("string")).alias("driverId"), o.alias("timestamp"),
                                 F.col("o_orderstatus").alias("status")))
    return table(spark, sf_dir, "orders").select(
        o.alias("order_id"), codec.alias("codec"), payload.alias("payload"), F.lit(10).alias("seconds"),
        (F.col("o_orderstatus") != "P").alias("ok"), ((o * 7919 + c * 31) % 5003).alias("latency_ms"))


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed and end offsets per partition: what orders and line items hold for each of 12 partitions."""
    lines = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 12).cast("int").alias("partition")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_linenumber").cast("bigint")).alias("numbers"))
    return lines.select("partition", (F.col("numbers") * 9 / 10).cast("bigint").alias("committed_offset"),
                        (F.col("lines") * 3).alias("end_offset"))
