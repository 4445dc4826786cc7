"""Delivery figures, percentiles, resolution reports and ordered series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import half_up
from ..operators import metrics as M, series as W
from ..operators.percentiles import last_samples, pctl
from ..operators.quality import with_cell
from . import inputs as I, sqltext as Q
from .cells import _zone_cells_sql, zone_polygons
from .registry import query


def _delivery_sql(by: str) -> str:
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {lead}successes, failures, CASE WHEN successes = 0 THEN 0e0 ELSE {Q.half_up('latency_sum / successes', 6)} END AS mean_latency_ms,
  successes * 100.0e0 / greatest(successes + failures, 1) AS success_pct, failures * 100.0e0 / greatest(successes + failures, 1) AS failure_pct FROM (
  SELECT {lead}count(*) FILTER (ok) AS successes, count(*) FILTER (NOT ok) AS failures, coalesce(sum(latency_ms) FILTER (ok), 0) AS latency_sum FROM {Q.RUNS} {group})"""


def _delivery(spark, d, by=None):
    return M.delivery_stats(I.run_table(spark, d), by=by).withColumn("mean_latency_ms", half_up("mean_latency_ms", 6))


@query("delivery_stats", _delivery_sql(""))
def delivery_stats(spark, d):
    return _delivery(spark, d)


@query("delivery_stats_by_codec", _delivery_sql("codec"))
def delivery_stats_by_codec(spark, d):
    return _delivery(spark, d, ["codec"])


@query("resolution_mix", f"""SELECT total, res9, res10, (res9 * 9.0e0 + res10 * 10.0e0) / total AS mean_resolution FROM (SELECT count(*) AS total,
  count(*) FILTER (event_id % 16 = 9) AS res9, count(*) FILTER (event_id % 16 = 10) AS res10 FROM events)""")
def resolution_mix(spark, d):
    return M.resolution_mix(I.h3_ids(spark, d))


def _resolution_sql() -> str:
    parts = [f"""SELECT {r} AS resolution, count(*) AS cells, count(*) FILTER (o.cell IS NULL) AS empty_cells,
      CASE WHEN count(*) = 0 THEN 0e0 ELSE count(*) FILTER (o.cell IS NULL) / count(*) END AS empty_ratio
      FROM (SELECT DISTINCT cell FROM {_zone_cells_sql(r)}) z LEFT JOIN (SELECT DISTINCT cell FROM {Q.with_cell(Q.PINGS, r)}) o ON o.cell = z.cell""" for r in (5, 7, 9)]
    return " UNION ALL ".join(parts)


@query("resolution_report", _resolution_sql())
def resolution_report(spark, d):
    return M.resolution_report(I.pings(spark, d), zone_polygons(spark, d), [5, 7, 9])


@query("lag_report", f"""SELECT partition, CAST(sum(committed_offset) AS BIGINT) AS committed_offset, CAST(sum(end_offset) AS BIGINT) AS end_offset,
  CAST(sum(greatest(end_offset - committed_offset, 0)) AS BIGINT) AS lag, count(*) AS partitions FROM {Q.OFFSETS} GROUP BY ROLLUP (partition)""")
def lag_report(spark, d):
    return M.lag_report(I.offsets(spark, d))


@query("batch_efficiency", """SELECT o_orderpriority, events, batch_bytes_avg, request_rate, batch_bytes_avg / 16384.0e0 * 100.0e0 AS batch_fill_pct,
  (1.0e0 - request_rate / events) * 100.0e0 AS request_cut_pct FROM (SELECT o_orderpriority, count(*) AS events,
  CAST(sum(o_orderkey % 16384) AS DOUBLE) / count(*) AS batch_bytes_avg, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS request_rate FROM orders GROUP BY 1)""")
def batch_efficiency(spark, d):
    runs = I.table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("events"), (F.sum(F.col("o_orderkey") % 16384).cast("double") / F.count(F.lit(1))).alias("batch_bytes_avg"),
        F.count_distinct("o_custkey").cast("double").alias("request_rate"))
    return M.batch_efficiency(runs)


_RANKS = {"i": "CAST(floor(p * n) AS BIGINT)", "j": "CAST(ceil(p * n) AS BIGINT) - 1", "k": "CAST(floor(p * n) AS BIGINT)"}


def _pctl_sql(kind: str, src: str, value: str) -> str:
    return f"""SELECT p, {value} FROM (SELECT {value}, row_number() OVER (ORDER BY {value}) - 1 AS rk, count(*) OVER () AS n FROM {src}),
      (SELECT unnest([0.5e0, 0.99e0]) AS p) WHERE rk = greatest(least({_RANKS[kind]}, n - 1), 0)"""


@query("percentile_floor_rank", _pctl_sql("i", Q.RUNS, "latency_ms"))
def percentile_floor_rank(spark, d):
    return pctl(I.run_table(spark, d), "latency_ms", "i", (0.5, 0.99))


@query("percentile_nearest_rank", _pctl_sql("j", f"(SELECT * FROM {Q.RUNS} ORDER BY order_id DESC LIMIT 10000)", "latency_ms"))
def percentile_nearest_rank(spark, d):
    return pctl(last_samples(I.run_table(spark, d), "order_id"), "latency_ms", "j", (0.5, 0.99))


@query("percentile_fixed_rank", _pctl_sql("k", "lineitem", "l_extendedprice"))
def percentile_fixed_rank(spark, d):
    return pctl(I.table(spark, d, "lineitem"), "l_extendedprice", "k", (0.5, 0.99))


# ---- series ----------------------------------------------------------------

_COUNTER = f"(SELECT status, event_id, ts_ms, event_id AS value, lag(event_id) OVER w AS bv, lag(ts_ms) OVER w AS bt FROM {Q.PINGS} WINDOW w AS (PARTITION BY status ORDER BY event_id))"
_RATE = "CASE WHEN (ts_ms - bt) / 1000.0e0 > 0.5e0 THEN (value - bv) / ((ts_ms - bt) / 1000.0e0) ELSE 0e0 END"


def _counter(spark, d):
    return I.pings(spark, d).select("status", "event_id", "ts_ms", F.col("event_id").alias("value"))


@query("counter_rate", f"SELECT status, event_id, {Q.half_up(_RATE, 6)} AS rate FROM {_COUNTER}")
def counter_rate(spark, d):
    rated = W.counter_rate(_counter(spark, d), ["status"], "event_id")
    return rated.select("status", "event_id", half_up("rate", 6).alias("rate"))


@query("counter_rate_fixed_interval", f"SELECT status, event_id, (value - coalesce(bv, 0)) // 5 AS rate FROM {_COUNTER}")
def counter_rate_fixed_interval(spark, d):
    return W.counter_rate(_counter(spark, d), ["status"], "event_id", fixed_seconds=5).select("status", "event_id", "rate")


@query("moving_average_rate", f"""SELECT status, event_id, {Q.half_up('m', 6)} AS moving_avg FROM (SELECT status, event_id,
  avg(rate) OVER (PARTITION BY status ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m FROM (SELECT status, event_id, {Q.half_up(_RATE, 6)} AS rate FROM {_COUNTER}))""")
def moving_average_rate(spark, d):
    averaged = W.moving_rate(_counter(spark, d), ["status"], "event_id", rounded=lambda rate: half_up(rate, 6))
    return averaged.select("status", "event_id", half_up("moving_avg", 6).alias("moving_avg"))


@query("throughput_per_interval", f"SELECT CAST(floor(ts_ms / 10000) AS BIGINT) * 10000 AS window_ms, count(*) AS records FROM {Q.PINGS} GROUP BY 1")
def throughput_per_interval(spark, d):
    from ..functions.scalar import epoch_millis
    return W.throughput(I.pings(spark, d), "10 seconds").select(epoch_millis("window_start").alias("window_ms"), "records")


BREACH_MS, BREACH_TARGET = 600_000, 0.0025
_SAMPLES = f"""(SELECT s.sample, coalesce(c.records, 0) AS records FROM (SELECT unnest(range((SELECT min(ts_ms) // {BREACH_MS} FROM {Q.PINGS}),
  (SELECT max(ts_ms) // {BREACH_MS} FROM {Q.PINGS}) + 1)) AS sample) s LEFT JOIN (SELECT ts_ms // {BREACH_MS} AS sample, count(*) AS records FROM {Q.PINGS} GROUP BY 1) c ON c.sample = s.sample)"""
_BREACH = f"""SELECT sample, records, {Q.half_up('share', 9)} AS rate_share, judged, streak, streak >= 3 AS breach FROM (SELECT *,
   CAST(sum(slow) OVER (PARTITION BY island ORDER BY sample) AS BIGINT) AS streak FROM (SELECT *, sum(CASE WHEN judged AND slow = 0 THEN 1 ELSE 0 END) OVER (ORDER BY sample) AS island
    FROM (SELECT *, CASE WHEN judged AND share < 0.92e0 THEN 1 ELSE 0 END AS slow FROM (SELECT *, records / {Q.num(BREACH_MS / 1000.0)} / {Q.num(BREACH_TARGET)} AS share,
     coalesce(lag(records) OVER (ORDER BY sample) > 0, false) AS judged FROM {_SAMPLES}))))"""


@query("sustained_breach", _BREACH)
def sustained_breach(spark, d):
    samples = W.sample_counts(I.pings(spark, d), every_ms=BREACH_MS)
    return W.sustained_breach(samples, BREACH_TARGET, every_ms=BREACH_MS).withColumn("rate_share", half_up("rate_share", 9))


@query("step_numbers", f"SELECT driver_id, event_id, row_number() OVER (PARTITION BY driver_id ORDER BY event_id) - 1 AS step FROM {Q.PINGS}")
def step_numbers(spark, d):
    return W.step_number(I.pings(spark, d).select("driver_id", "event_id"), ["driver_id"], "event_id")


_MOVES = f"""(SELECT * FROM (SELECT driver_id, event_id, ts_ms, cell, lag(cell) OVER w AS bc, lag(ts_ms) OVER w AS bt FROM {Q.with_cell(Q.PINGS, 7)}
  WINDOW w AS (PARTITION BY driver_id ORDER BY event_id)) WHERE bc IS NULL OR bc <> cell)"""
_LINE = f"""(SELECT * EXCLUDE (x_, y_, q_, r_, s_, nq_, nr_, ns_, dq_, dr_, ds_, fq_, fr_) FROM (SELECT *, 0e0 AS x_, 0e0 AS y_,
  q0 + 1e-6 + (q1 - q0) * share AS q_, r0 + 2e-6 + (r1 - r0) * share AS r_, {Q._round_and_pack(7)} AS between_cell FROM (
  SELECT *, CAST(i AS DOUBLE) / CAST(n AS DOUBLE) AS share FROM (SELECT *, unnest(range(1, n)) AS i FROM (
   SELECT *, CAST((abs(q1 - q0) + abs(r1 - r0) + abs(q1 + r1 - q0 - r0)) / 2.0e0 AS BIGINT) AS n FROM (
    SELECT *, CAST(((bc >> 26) & 67108863) - 33554432 AS DOUBLE) AS q0, CAST((bc & 67108863) - 33554432 AS DOUBLE) AS r0,
      CAST(((cell >> 26) & 67108863) - 33554432 AS DOUBLE) AS q1, CAST((cell & 67108863) - 33554432 AS DOUBLE) AS r1 FROM {_MOVES} WHERE bc IS NOT NULL))))))"""


@query("cell_transitions", f"""SELECT driver_id, ts_ms AS timestamp, cell AS current_cell, false AS interpolated FROM {_MOVES}
  UNION ALL SELECT driver_id, bt + CAST(floor((ts_ms - bt) * share) AS BIGINT), between_cell, true FROM {_LINE}""")
def cell_transitions(spark, d):
    return W.cell_transitions(with_cell(I.pings(spark, d), 7), 7)


@query("cell_transition_rate", f"""SELECT CAST(sum(changes) AS BIGINT) AS transitions, CAST(sum(span) AS BIGINT) AS driver_ms,
  {Q.half_up('sum(changes) * 1000.0e0 / sum(span)', 12)} AS per_driver_second FROM (SELECT driver_id, count(*) FILTER (bc <> cell) AS changes, max(ts_ms) - min(ts_ms) AS span FROM
  (SELECT driver_id, ts_ms, cell, lag(cell) OVER (PARTITION BY driver_id ORDER BY event_id) AS bc FROM {Q.with_cell(Q.PINGS, 9)}) GROUP BY 1)""")
def cell_transition_rate(spark, d):
    out = W.transition_rate(with_cell(I.pings(spark, d), 9))
    return out.withColumn("per_driver_second", half_up("per_driver_second", 12))


