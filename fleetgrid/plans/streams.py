"""Streaming operators, run over the given tables until everything available is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bits import cell_to_hex
from ..functions.scalar import epoch_millis
from ..operators import partitioning as P, skew as S
from ..operators.matching import match_as_of, tag_union
from ..operators.quality import with_cell
from ..operators.series import throughput
from ..operators.state import latest_by
from ..session import scratch_path
from ..sources.readers import read_table_stream, write_slices
from ..sources.writers import start
from ..streaming import jobs, processors as K
from . import inputs as I, sqltext as Q
from .cells import _VALID
from .registry import query


SLICES = 4  # parts of the table that every stream takes in one by one


def event_stream(spark, d, order="event_id"):
    """The events as a stream of several slices in the order of ``order``, one in each micro-batch."""
    events = I.table(spark, d, "events")
    rows = events if order in events.columns else events.withColumn(order, epoch_millis("ts"))
    path = scratch_path(spark, "intake")
    files = write_slices(rows, path, order, SLICES)
    return read_table_stream(spark, path, "part-", rows.schema, files)


def _slice_sql(order="event_id", rows="events"):
    """SQL of the number of the slice that a row lies in."""
    return f"CAST(floor(({order} - (SELECT min({order}) FROM {rows})) * {SLICES} / ((SELECT max({order}) - min({order}) + 1 FROM {rows}))) AS BIGINT)"


def ping_stream(spark, d):
    return I.ping_columns(event_stream(spark, d))


_REPEATS = f"""SELECT driver_id, arrival, bucket_ms FROM (SELECT driver_id, event_id AS arrival, ts_ms // 21600000 AS bucket_ms,
  lag(ts_ms // 21600000) OVER (PARTITION BY driver_id ORDER BY event_id) AS b FROM {Q.PINGS}) WHERE b IS NULL OR b <> bucket_ms"""


def _six_hours(spark, d):
    """Timestamps are cut to six hours, so that drivers do repeat them."""
    return ping_stream(spark, d).select("driver_id", F.col("event_id").alias("arrival"), F.floor(F.col("ts_ms") / 21600000).alias("bucket_ms"))


@query("stream_dedup_last", _REPEATS)
def stream_dedup_last(spark, d):
    return jobs.run_to_table(K.dedup_stream(_six_hours(spark, d), ts="bucket_ms", order=["arrival"]), "dedup")


@query("stream_dedup_in_batches", _REPEATS)
def stream_dedup_in_batches(spark, d):
    base = scratch_path(spark, "dedup-batches")
    rows = _six_hours(spark, d)
    jobs.dedup_in_batches(rows, base, "arrival", "bucket_ms").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/out").select("driver_id", "arrival", "bucket_ms")


@query("stream_dedup_with_expiry", f"""SELECT driver_id, arrival, bucket_ms, ts_ms FROM (SELECT driver_id, event_id AS arrival, ts_ms, ts_ms // 21600000 * 21600000 AS bucket_ms,
  lag(ts_ms // 21600000) OVER (PARTITION BY driver_id ORDER BY event_id) AS b FROM {Q.PINGS})
  WHERE b IS NULL OR b <> bucket_ms // 21600000 OR bucket_ms < ts_ms - 10800000""")
def stream_dedup_with_expiry(spark, d):
    """Of the pings of six hours, repeats go in the first half and pass in the second, when what was stored has expired."""
    rows = ping_stream(spark, d).select("driver_id", F.col("event_id").alias("arrival"), (F.floor(F.col("ts_ms") / 21600000) * 21600000).alias("bucket_ms"), "ts_ms")
    return jobs.run_to_table(K.dedup_stream(rows, ts="bucket_ms", order=["arrival"], ttl_ms=10_800_000, clock="ts_ms"), "dedup-ttl")


TTL_MS = 6 * 3_600_000
_BY_TIME = f"(SELECT driver_id, ts_ms, {_slice_sql('ts_ms', Q.PINGS)} AS slice FROM {Q.PINGS})"


def _by_time(spark, d):
    return I.ping_columns(event_stream(spark, d, "ts_ms")).select("driver_id", F.col("event_id").alias("arrival"), "ts_ms")


# After the slices comes one more batch, with the watermark that they leave behind.
@query("stream_live_state", f"""SELECT CAST(b.batch AS INTEGER) AS batch, driver_id, max(ts_ms) AS last_ms
  FROM (SELECT unnest(range({SLICES + 1})) AS batch) b JOIN {_BY_TIME} r ON r.slice <= b.batch
  GROUP BY b.batch, driver_id HAVING max(ts_ms) + {TTL_MS} + 1 >= coalesce((SELECT max(ts_ms) FROM {_BY_TIME} e WHERE e.slice < b.batch), 0)""")
def stream_live_state(spark, d):
    """The drivers whose last timestamp is still stored after each batch; timers have removed the others."""
    base = scratch_path(spark, "live")
    kept = K.dedup_stream(_by_time(spark, d), order=["ts_ms", "arrival"], ttl_ms=TTL_MS, clock="ts_ms", lateness="0 seconds")
    jobs.run_to_table(kept, "live", base=base)
    return jobs.live_state(spark, f"{base}/progress", "last", SLICES + 1).select("batch", "driver_id", F.col("ts").alias("last_ms"))


@query("stream_intake_per_batch", f"""SELECT {_slice_sql()} AS batch, count(*) AS records, min(event_id) AS first_event, max(event_id) AS last_event
  FROM events GROUP BY 1""")
def stream_intake_per_batch(spark, d):
    """What each micro-batch takes in where a trigger reads one slice."""
    taken = ping_stream(spark, d).select("event_id")
    base = scratch_path(spark, "intake-batches")

    def write(batch, number):
        batch.agg(F.count(F.lit(1)).alias("records"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")).write.mode(
            "overwrite").parquet(f"{base}/out/batch={number}")

    start(taken.writeStream.foreachBatch(write), f"{base}/progress").awaitTermination()
    return spark.read.schema("records bigint, first_event bigint, last_event bigint, batch bigint").parquet(f"{base}/out")


_BANDS = f"""SELECT 'geo' AS partitioner, CAST(abs(cell) % 12 AS INTEGER) AS partition, CAST(floor((lat + 90.0e0) / 10.0e0) AS INTEGER) AS lat_band,
  count(*) AS records FROM {Q.with_cell(Q.PINGS, 5)} GROUP BY ALL"""


@query("stream_band_counts", _BANDS)
def stream_band_counts(spark, d):
    """The counts emitted at the last trigger."""
    pings = P.assign_partition(with_cell(ping_stream(spark, d), 5), "mod", 12)
    emitted = jobs.run_to_table(S.partition_band_counts(pings, "geo"), "bands", "complete")
    last = emitted.groupBy("partitioner", "partition", "lat_band").agg(F.max_by("records", "batch").alias("records"))
    return last


@query("stream_band_counts_at_triggers", f"""SELECT b.batch, 'geo' AS partitioner, partition, lat_band, count(*) AS records FROM (SELECT unnest(range({SLICES})) AS batch) b
  JOIN (SELECT CAST(abs(cell) % 12 AS INTEGER) AS partition, CAST(floor((lat + 90.0e0) / 10.0e0) AS INTEGER) AS lat_band, {_slice_sql()} AS slice
   FROM {Q.with_cell(Q.PINGS, 5)}) r ON r.slice <= b.batch GROUP BY ALL""")
def stream_band_counts_at_triggers(spark, d):
    """The cumulative counts as they are emitted at every timed trigger."""
    pings = P.assign_partition(with_cell(ping_stream(spark, d), 5), "mod", 12)
    emitted = jobs.run_to_table(S.partition_band_counts(pings, "geo"), "bands-timed", "complete", every="1 second")
    return emitted.select("batch", "partitioner", "partition", "lat_band", "records")


@query("stream_throughput", f"SELECT CAST(floor(ts_ms / 10000) AS BIGINT) * 10000 AS window_ms, count(*) AS records FROM {Q.PINGS} GROUP BY 1")
def stream_throughput(spark, d):
    counted = throughput(ping_stream(spark, d).withColumn("event_ts", F.col("event_ts").cast("timestamp")), "10 seconds", watermark="1 minute")
    emitted = jobs.run_to_table(counted, "throughput", "update")
    last = emitted.groupBy("window_start").agg(F.max_by("records", "batch").alias("records"))
    return last.select(epoch_millis("window_start").alias("window_ms"), "records")


# Riders are the odd events, asking at the place of their event; even events are driver pings.
_SPLIT = Q.with_cell(Q.PINGS, 6)


_AS_OF = f"""SELECT rider_id, driver_id, cell, arrival FROM (
  SELECT concat('rider-', CAST(event_id AS VARCHAR)) AS rider_id, cell, event_id AS arrival, event_id % 2 AS is_rider,
   last_value(CASE WHEN event_id % 2 = 0 THEN driver_id END IGNORE NULLS) OVER w AS driver_id,
   last_value(CASE WHEN event_id % 2 = 0 THEN status END IGNORE NULLS) OVER w AS now_status FROM {_SPLIT}
  WINDOW w AS (PARTITION BY cell ORDER BY event_id)) WHERE is_rider = 1 AND now_status = 'AVAILABLE'"""


def _both_sides(pings):
    events = with_cell(pings, 6)
    drivers = events.filter(F.col("event_id") % 2 == 0)
    riders = events.filter(F.col("event_id") % 2 == 1).withColumn("rider_id", F.concat(F.lit("rider-"), F.col("event_id").cast("string")))
    return tag_union(riders, drivers, "event_id", "event_id")


@query("match_as_of_arrival", _AS_OF)
def match_as_of_arrival(spark, d):
    """The batch twin of the two streaming matches below."""
    return match_as_of(_both_sides(I.pings(spark, d)))


@query("stream_match_same_cell", _AS_OF)
def stream_match_same_cell(spark, d):
    return jobs.run_to_table(K.match_same_cell_stream(_both_sides(ping_stream(spark, d))), "match")


@query("stream_match_in_batches", _AS_OF)
def stream_match_in_batches(spark, d):
    base = scratch_path(spark, "match-batches")
    jobs.match_in_batches(_both_sides(ping_stream(spark, d)), base).awaitTermination()
    return spark.read.schema(K.MATCH_SCHEMA).parquet(f"{base}/out").select("rider_id", "driver_id", "cell", "arrival")


@query("stream_process_pings", f"SELECT event_id, driver_id, cell, cell AS key FROM {_VALID} WHERE is_valid")
def stream_process_pings(spark, d):
    """The forwarded side: every valid ping, keyed by cell."""
    rows = I.as_h3_ids(ping_stream(spark, d)).select("event_id", "driver_id", "cell")
    return jobs.run_to_table(jobs.process_pings(rows, "event_id")[0], "forwarded")


@query("stream_process_pings_state", f"SELECT driver_id, event_id, cell FROM {Q.latest(f'(SELECT * FROM {_VALID} WHERE is_valid)', 'driver_id')}")
def stream_process_pings_state(spark, d):
    """The state side: the last row each driver reached."""
    rows = I.as_h3_ids(ping_stream(spark, d)).select("event_id", "driver_id", "cell")
    emitted = jobs.run_to_table(jobs.process_pings(rows, "event_id")[1], "state", "update")
    return latest_by(emitted.drop("batch"), ["driver_id"], "event_id").select("driver_id", "event_id", "cell")


@query("stream_process_pings_together", f"""SELECT driver_id, event_id, cell, forwarded FROM {Q.latest(f'(SELECT * FROM {_VALID} WHERE is_valid)', 'driver_id')}
  JOIN (SELECT driver_id, count(*) AS forwarded FROM {_VALID} WHERE is_valid GROUP BY 1) USING (driver_id)""")
def stream_process_pings_together(spark, d):
    """Forwarded rows, counted for each driver, and the driver's state, both from one query over one reading."""
    base = scratch_path(spark, "process")
    rows = I.as_h3_ids(ping_stream(spark, d)).select("event_id", "driver_id", "cell")
    jobs.process_to_tables(rows, "event_id", base).awaitTermination()
    forwarded = spark.read.parquet(f"{base}/forwarded").groupBy("driver_id").agg(F.count(F.lit(1)).alias("forwarded"))
    return jobs.driver_state(spark, base, rows.schema, SLICES).join(forwarded, "driver_id").select("driver_id", "event_id", "cell", "forwarded")


@query("stream_boundary_multicast_repeats", f"""SELECT event_id, driver_id, ts_ms, cell AS target_cell FROM (SELECT event_id, driver_id, ts_ms // 21600000 AS ts_ms, cell,
  lag(ts_ms // 21600000) OVER (PARTITION BY driver_id ORDER BY event_id) AS b FROM {Q.with_parent(Q.with_cell(Q.PINGS, 9, 'fine'), 9, 5, 'cell', 'fine')})
  WHERE b IS NULL OR b <> ts_ms""")
def stream_boundary_multicast_repeats(spark, d):
    """Drivers repeat their timestamps, so whole pings are dropped besides the copies."""
    rows = ping_stream(spark, d).select("event_id", "driver_id", "lat", "lon", F.floor(F.col("ts_ms") / 21600000).alias("ts_ms"))
    return jobs.run_to_table(jobs.boundary_stream(rows), "boundary").select("event_id", "driver_id", "ts_ms", "target_cell")


@query("stream_boundary_multicast_dedup", f"SELECT event_id, driver_id, cell AS target_cell FROM {Q.with_parent(Q.with_cell(Q.PINGS, 9, 'fine'), 9, 5, 'cell', 'fine')}")
def stream_boundary_multicast_dedup(spark, d):
    """Every ping leaves once, as its primary copy: the others are dropped again."""
    rows = ping_stream(spark, d).select("event_id", "driver_id", "lat", "lon", "ts_ms")
    return jobs.run_to_table(jobs.boundary_stream(rows), "boundary").select("event_id", "driver_id", "target_cell")


@query("stream_latest_per_driver", f"SELECT driver_id, event_id, status FROM {Q.latest(Q.PINGS, 'driver_id')}")
def stream_latest_per_driver(spark, d):
    """Latest state kept by a plain streaming aggregate."""
    latest = ping_stream(spark, d).groupBy("driver_id").agg(F.max_by(F.struct("event_id", "status"), "event_id").alias("r"))
    emitted = jobs.run_to_table(latest.select("driver_id", "r.event_id", "r.status"), "latest-agg", "update")
    return emitted.groupBy("driver_id").agg(F.max("event_id").alias("event_id"), F.max_by("status", "event_id").alias("status"))


@query("stream_keyed_sink", f"SELECT event_id, driver_id, lower(hex(cell)) AS key FROM {Q.with_cell(Q.PINGS, 9)} WHERE status = 'AVAILABLE'")
def stream_keyed_sink(spark, d):
    rows = with_cell(ping_stream(spark, d), 9).filter("status = 'AVAILABLE'").select("event_id", "driver_id", cell_to_hex("cell").alias("key"))
    return jobs.run_to_table(rows, "keyed")

