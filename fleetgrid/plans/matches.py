"""State tables and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import dbl, half_up
from ..operators import boundary as B, matching as M, metrics, state
from ..operators.nearest import match_nearest
from ..operators.quality import with_cell
from . import inputs as I, sqltext as Q
from .registry import query

NOW_MS = 1706745600000
P7, R7 = Q.with_cell(Q.PINGS, 7), Q.with_cell(Q.RIDERS, 7)


def _same_cell_sql(res: int = 7, available: str | None = "after") -> str:
    pings = Q.with_cell(Q.PINGS, res)
    if available == "before":
        pings = f"(SELECT * FROM {pings} WHERE status = 'AVAILABLE')"
    where = "WHERE t.status = 'AVAILABLE'" if available == "after" else ""
    return (f"SELECT r.rider_id, t.driver_id, r.cell, {NOW_MS} - r.request_ms AS latency_ms FROM {Q.with_cell(Q.RIDERS, res)} r "
            f"JOIN {Q.latest(pings, 'cell')} t ON r.cell = t.cell {where}")


def _same_cell(spark, d, res=7, available: str | None = "after"):
    return M.match_same_cell(with_cell(I.riders(spark, d), res), with_cell(I.pings(spark, d), res), "event_id", available, F.lit(NOW_MS))


@query("match_same_cell", _same_cell_sql())
def match_same_cell(spark, d):
    return _same_cell(spark, d)


@query("match_same_cell_available_before", _same_cell_sql(available="before"))
def match_same_cell_available_before(spark, d):
    return _same_cell(spark, d, available="before")


@query("match_same_cell_any_status", _same_cell_sql(6, None))
def match_same_cell_any_status(spark, d):
    return _same_cell(spark, d, 6, None)


@query("match_summary", f"""SELECT requests, matches, latency_sum, CASE WHEN matches = 0 THEN 0e0 ELSE {Q.half_up('latency_sum / matches', 2)} END AS mean_latency_ms,
  CASE WHEN requests = 0 THEN 0e0 ELSE {Q.half_up('matches * 100.0e0 / requests', 2)} END AS match_pct
  FROM (SELECT count(*) AS matches, CAST(coalesce(sum(latency_ms), 0) AS BIGINT) AS latency_sum FROM ({_same_cell_sql()})), (SELECT count(*) AS requests FROM orders)""")
def match_summary(spark, d):
    return metrics.match_summary(I.riders(spark, d), _same_cell(spark, d))


# The nearest driver among the 19 cells around a rider, from all pairs that share a neighbourhood.
_STATE9 = Q.latest(Q.with_cell(Q.PINGS, 9), "cell, driver_id")


def _nearest_sql(drivers: str, res: int = 9, k: int = 2, riders: str = Q.RIDERS, turns: str = "0") -> str:
    near = f"""(SELECT r.*, r.cell + o.d + w.turns * {Q.turn(res)} AS near FROM {Q.with_cell(riders, res)} r, {Q.disk(k)} o,
      (SELECT unnest([{turns}]) AS turns) w)"""
    pairs = f"""SELECT n.rider_id, s.driver_id, s.lat AS driver_lat, s.lon AS driver_lon,
      {Q.haversine('n.lat', 'n.lon', 's.lat', 's.lon')} AS km FROM {near} n JOIN {drivers} s ON s.cell = n.near"""
    return f"""SELECT rider_id, driver_id, {Q.half_up('driver_lat', 9)} AS driver_lat, {Q.half_up('driver_lon', 9)} AS driver_lon, {Q.half_up('km', 6)} AS distance_km
      FROM (SELECT *, row_number() OVER (PARTITION BY rider_id ORDER BY km, driver_id) AS rn FROM ({pairs})) WHERE rn = 1"""


def _rounded(matches):
    return matches.select("rider_id", "driver_id", half_up("driver_lat", 9).alias("driver_lat"),
                          half_up("driver_lon", 9).alias("driver_lon"), half_up("distance_km", 6).alias("distance_km"))


@query("match_nearest", _nearest_sql(_STATE9))
def match_nearest_query(spark, d):
    drivers = state.latest_per_cell_driver(with_cell(I.pings(spark, d), 9), "event_id")
    return _rounded(match_nearest(I.riders(spark, d), drivers))


# Half of the pings, each a driver of its own, and a third of the riders drawn together to a tenth of the area's width.
_DRAWN = (40.6, -74.0, 0.1)


def _drawn_sql(src: str, which: str) -> str:
    lat, lon, share = map(Q.num, _DRAWN)
    return f"(SELECT * REPLACE (CASE WHEN {which} THEN {lat} + (lat - {lat}) * {share} ELSE lat END AS lat, CASE WHEN {which} THEN {lon} + (lon - {lon}) * {share} ELSE lon END AS lon) FROM {src})"


def _drawn(df, which):
    lat, lon, share = map(dbl, _DRAWN)
    return df.withColumns({"lat": F.when(which, lat + (F.col("lat") - lat) * share).otherwise(F.col("lat")),
                           "lon": F.when(which, lon + (F.col("lon") - lon) * share).otherwise(F.col("lon"))})


@query("match_nearest_crowded", _nearest_sql(
    Q.with_cell(f"(SELECT * REPLACE (concat('ping-', CAST(event_id AS VARCHAR)) AS driver_id) FROM {_drawn_sql(Q.PINGS, 'event_id % 2 = 0')})", 7),
    7, 1, _drawn_sql(Q.RIDERS, "order_id % 3 = 0")))
def match_nearest_crowded(spark, d):
    drivers = _drawn(I.pings(spark, d), F.col("event_id") % 2 == 0).withColumn("driver_id", F.concat(F.lit("ping-"), F.col("event_id").cast("string")))
    return _rounded(match_nearest(_drawn(I.riders(spark, d), F.col("order_id") % 3 == 0), drivers, 7, 1))


@query("match_nearest_across_seam", _nearest_sql(Q.latest(Q.with_cell(Q.at_seam(Q.PINGS), 7), "cell, driver_id"), 7, 2, Q.at_seam(Q.RIDERS), "-1, 0, 1"))
def match_nearest_across_seam(spark, d):
    """Riders and drivers on both sides of the antimeridian."""
    drivers = state.latest_per_cell_driver(with_cell(I.at_seam(I.pings(spark, d)), 7), "event_id")
    return _rounded(match_nearest(I.at_seam(I.riders(spark, d)), drivers, 7, 2))


@query("match_nearest_moved_evicted", _nearest_sql(Q.latest(Q.with_cell(Q.PINGS, 7), "driver_id"), 7, 2))
def match_nearest_moved_evicted(spark, d):
    drivers = state.latest_per_cell_driver(with_cell(I.pings(spark, d), 7), "event_id", evict_moved=True)
    return _rounded(match_nearest(I.riders(spark, d), drivers, 7, 2))


@query("latest_per_driver", f"SELECT driver_id, event_id, ts_ms, status, {Q.half_up('lat', 9)} AS lat, {Q.half_up('lon', 9)} AS lon FROM {Q.latest(Q.PINGS, 'driver_id')}")
def latest_per_driver(spark, d):
    pings = I.pings(spark, d).select("driver_id", "event_id", "ts_ms", "status", "lat", "lon")
    return state.latest_by(pings, ["driver_id"], "event_id").withColumns({"lat": half_up("lat", 9), "lon": half_up("lon", 9)})


@query("latest_position_per_cell", f"SELECT cell, event_id, ts_ms FROM {Q.latest(P7, 'cell')}")
def latest_position_per_cell(spark, d):
    return state.latest_by(with_cell(I.pings(spark, d), 7).select("cell", "event_id", "ts_ms"), ["cell"], "event_id")


@query("latest_driver_per_cell", f"SELECT cell, driver_id, event_id, status FROM {Q.latest(P7, 'cell')}")
def latest_driver_per_cell(spark, d):
    return state.latest_by(with_cell(I.pings(spark, d), 7).select("cell", "driver_id", "event_id", "status"), ["cell"], "event_id")


@query("latest_per_cell_driver", f"SELECT cell, driver_id, event_id, status FROM {Q.latest(P7, 'cell, driver_id')}")
def latest_per_cell_driver(spark, d):
    return state.latest_per_cell_driver(with_cell(I.pings(spark, d), 7).select("cell", "driver_id", "event_id", "status"), "event_id")


@query("latest_per_cell_driver_moved_evicted", f"SELECT cell, driver_id, event_id, status FROM {Q.latest(P7, 'driver_id')}")
def latest_per_cell_driver_moved_evicted(spark, d):
    return state.latest_per_cell_driver(with_cell(I.pings(spark, d), 7).select("cell", "driver_id", "event_id", "status"), "event_id", True)


@query("driver_cells", f"SELECT driver_id, cell FROM {Q.latest(P7, 'driver_id')}")
def driver_cells(spark, d):
    return state.driver_cells(with_cell(I.pings(spark, d), 7), "event_id")


@query("driver_lookup", f"SELECT driver_id, event_id, cell FROM {Q.latest(P7, 'driver_id')} WHERE driver_id = 'driver-7'")
def driver_lookup(spark, d):
    table = state.latest_by(with_cell(I.pings(spark, d), 7).select("driver_id", "event_id", "cell"), ["driver_id"], "event_id")
    return state.lookup(table, "driver-7")


@query("top_driver_per_cell", f"""SELECT cell, driver_id, event_id FROM (SELECT cell, driver_id, event_id,
  row_number() OVER (PARTITION BY cell ORDER BY lat, event_id) AS rn FROM {P7}) WHERE rn = 1""")
def top_driver_per_cell(spark, d):
    return M.top1(with_cell(I.pings(spark, d), 7), ["cell"], ["lat", "event_id"]).select("cell", "driver_id", "event_id")


_COPIES = f"""(SELECT event_id, driver_id, ts_ms, p5 AS primary_cell, coarse AS target_cell, coarse = p5 AS is_primary FROM (
  SELECT DISTINCT t.event_id, t.driver_id, t.ts_ms, t.coarse, t.p5 FROM {Q.with_parent(
    Q.with_parent(f'(SELECT p.*, p.cell + o.d AS near FROM {Q.with_cell(Q.PINGS, 9)} p, {Q.disk(3)} o)', 9, 5, 'coarse', 'near'), 9, 5, 'p5')} t))"""


@query("boundary_multicast", f"""SELECT event_id, driver_id, target_cell, is_primary,
  concat(CAST(target_cell AS VARCHAR), '|', CAST(abs({Q.signed32(Q.string_hash('driver_id'))}) % 8 AS VARCHAR)) AS partition_key FROM {_COPIES}""")
def boundary_multicast(spark, d):
    return B.multicast(I.pings(spark, d)).select("event_id", "driver_id", "target_cell", "is_primary", "partition_key")


_DOUBLED = f"(SELECT *, 0 AS again FROM {Q.PINGS} UNION ALL SELECT *, 1 AS again FROM {Q.PINGS} WHERE event_id % 10 = 0)"


def doubled(spark, d):
    """Pings of which every tenth is delivered twice in a row for its driver or, further on, once more."""
    pings = I.pings(spark, d)
    repeated = pings.filter(F.col("event_id") % 10 == 0)
    out = pings.withColumn("again", F.lit(0)).unionByName(repeated.withColumn("again", F.lit(1)))
    return out.withColumn("arrival", F.col("event_id") * 2 + F.col("again"))


@query("dedup_last_timestamp", f"""SELECT driver_id, arrival, ts_ms FROM (SELECT driver_id, event_id * 2 + again AS arrival, ts_ms,
  lag(ts_ms) OVER (PARTITION BY driver_id ORDER BY event_id * 2 + again) AS b FROM {_DOUBLED}) WHERE b IS NULL OR b <> ts_ms""")
def dedup_last_timestamp(spark, d):
    return B.dedup_last(doubled(spark, d).select("driver_id", "arrival", "ts_ms"), "arrival")


@query("dedup_all_seen", f"SELECT DISTINCT driver_id, ts_ms FROM {_DOUBLED}")
def dedup_all_seen(spark, d):
    return B.dedup_last(doubled(spark, d).select("driver_id", "ts_ms"), "ts_ms", mode="all_seen")


@query("boundary_stats", f"""SELECT total_processed, boundary_hits, multicast_copies, multicast_copies AS dedup_drops,
  multicast_copies / total_processed AS amplification FROM (SELECT count(*) AS total_processed, count(*) FILTER (n > 1) AS boundary_hits,
   CAST(sum(n - 1) AS BIGINT) AS multicast_copies FROM (SELECT event_id, count(*) AS n FROM {_COPIES} GROUP BY 1))""")
def boundary_stats(spark, d):
    return B.boundary_stats(I.pings(spark, d))


@query("distinct_cells", f"SELECT DISTINCT cell FROM {P7}")
def distinct_cells(spark, d):
    return metrics.distinct_cells(with_cell(I.pings(spark, d), 7))


@query("distinct_cell_count", f"SELECT count(DISTINCT cell) AS distinct_cells FROM {P7}")
def distinct_cell_count(spark, d):
    return metrics.distinct_cell_count(with_cell(I.pings(spark, d), 7))
