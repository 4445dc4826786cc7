"""Decoding, validation, projections and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import dbl, latency_ms, padded_id, round2
from ..operators import metrics, quality as P, state
from ..operators.partitioning import partition_of
from ..schemas import PING
from ..session import scratch_path
from ..sources import codecs as C, readers, writers
from . import inputs as I, sqltext as Q
from .registry import query

WIRE = ["event_id", "driver_id", "lat", "lon", "ts_ms", "status"]


def _outcome(decoded: C.Decoded, *columns: str):
    """Good and rejected rows in one table, so the counts can be seen to add up."""
    return decoded.rows.select(*columns, "reason")


def _nulled(condition: str, reason: str, *columns: str) -> str:
    kept = ", ".join(f"CASE WHEN {condition} THEN NULL ELSE {c} END AS {c}" for c in columns)
    return f"event_id, {kept}, CASE WHEN {condition} THEN '{reason}' END AS reason"


@query("json_pings", f"SELECT {_nulled('event_id % 97 = 0', 'unparsable', 'driver_id', 'lat', 'lon', 'ts_ms', 'status')} FROM {Q.PINGS}")
def json_pings(spark, d):
    return _outcome(C.decode_json(_json_raw(spark, d)), *WIRE)


def _json_raw(spark, d):
    """JSON payloads, some of them cut off."""
    text = C.encode_json("driver_id", "lat", "lon", "ts_ms", "status")
    broken = F.substring(text, F.lit(1), F.length(text) - 9)
    return I.pings(spark, d).select("event_id", F.when(F.col("event_id") % 97 == 0, broken).otherwise(text).alias("value"))


@query("csv_pings", f"SELECT event_id, driver_id, {Q.half_up('lat', 6)} AS lat, {Q.half_up('lon', 6)} AS lon, ts_ms, status, NULL::VARCHAR AS reason FROM {Q.PINGS}")
def csv_pings(spark, d):
    raw = I.pings(spark, d).select("event_id", C.encode_csv("ping").alias("value"))
    return _outcome(C.decode_csv(raw, "ping"), *WIRE)


@query("csv_riders", f"""SELECT order_id, CASE WHEN order_id % 50 = 0 THEN NULL ELSE rider_id END AS rider_id,
  CASE WHEN order_id % 50 = 0 THEN NULL ELSE {Q.half_up('lat', 6)} END AS lat, CASE WHEN order_id % 50 = 0 THEN NULL ELSE {Q.half_up('lon', 6)} END AS lon,
  CASE WHEN order_id % 50 = 0 THEN NULL ELSE request_ms END AS request_ms, CASE WHEN order_id % 50 = 0 THEN 'unparsable' END AS reason FROM {Q.RIDERS}""")
def csv_riders(spark, d):
    text = C.encode_csv("rider")
    raw = I.riders(spark, d).select("order_id", F.when(F.col("order_id") % 50 == 0, F.concat(F.lit("x,north,"), text)).otherwise(text).alias("value"))
    return _outcome(C.decode_csv(raw, "rider"), "order_id", "rider_id", "lat", "lon", "request_ms")


@query("binary_fixed28", f"SELECT event_id, user_id AS driver_id, lat, lon, ts_ms FROM {Q.PINGS}")
def binary_fixed28(spark, d):
    raw = C.encode_binary(I.pings(spark, d).withColumn("driver_id", F.col("user_id")), "fixed28").select("event_id", "value")
    return C.decode_binary(raw, "fixed28").good


@query("binary_fixed40", f"""SELECT event_id, ts_ms, lat, lon, CAST(event_id % 360 AS DOUBLE) + 0.5e0 AS heading,
  CAST(CAST(user_id % 334 AS DOUBLE) / 8.0e0 AS DOUBLE) AS speed_mps FROM {Q.PINGS}""")
def binary_fixed40(spark, d):
    moving = I.pings(spark, d).withColumns({
        "heading": (F.col("event_id") % 360).cast("double") + dbl(0.5), "speed_mps": (F.col("user_id") % 334).cast("double") / dbl(8.0)})
    return C.decode_binary(C.encode_binary(moving, "fixed40").select("event_id", "value"), "fixed40").good


@query("binary_prefixed_pings", f"SELECT {_nulled('event_id % 71 = 0', 'length', 'driver_id', 'lat', 'lon', 'cell', 'ts_ms')} FROM {Q.with_cell(Q.PINGS, 6)}")
def binary_prefixed_pings(spark, d):
    whole = C.encode_binary(P.with_cell(I.pings(spark, d), 6), "lp_ping")
    cut = F.col("value").substr(F.lit(1), F.octet_length("value") - 3)
    raw = whole.select("event_id", F.when(F.col("event_id") % 71 == 0, cut).otherwise(F.col("value")).alias("value"))
    return _outcome(C.decode_binary(raw, "lp_ping"), "event_id", "driver_id", "lat", "lon", "cell", "ts_ms")


@query("binary_prefixed_status", f"SELECT event_id, driver_id, lat, lon, ts_ms, status FROM {Q.PINGS}")
def binary_prefixed_status(spark, d):
    return C.decode_binary(C.encode_binary(I.pings(spark, d), "lp_status").select("event_id", "value"), "lp_status").good


@query("binary_prefixed_riders", f"SELECT order_id, rider_id, lat, lon, cell, request_ms AS ts_ms FROM {Q.with_cell(Q.RIDERS, 6)}")
def binary_prefixed_riders(spark, d):
    rows = P.with_cell(I.riders(spark, d), 6).withColumnRenamed("request_ms", "ts_ms")
    return C.decode_binary(C.encode_binary(rows, "lp_rider").select("order_id", "value"), "lp_rider").good


def _match_payload_sql() -> str:
    from .matches import _same_cell_sql
    return f"SELECT rider_id, driver_id, cell, latency_ms FROM ({_same_cell_sql(6, None)})"


@query("binary_match_events", _match_payload_sql())
def binary_match_events(spark, d):
    from .matches import match_same_cell_any_status
    return C.decode_binary(C.encode_binary(match_same_cell_any_status(spark, d), "lp_match").select("value"), "lp_match").good


@query("binary_location_keys", f"SELECT event_id, driver_id AS entity_id, cell FROM {Q.H3_IDS}")
def binary_location_keys(spark, d):
    rows = I.h3_ids(spark, d).withColumn("entity_id", F.col("driver_id"))
    return C.decode_binary(C.encode_binary(rows, "lp_key").select("event_id", "value"), "lp_key").good


@query("composite_keys", f"""SELECT event_id, CASE WHEN bad IS NULL THEN driver_id END AS entity_id, CASE WHEN bad IS NULL THEN lat END AS lat,
  CASE WHEN bad IS NULL THEN lon END AS lon, bad AS reason FROM (SELECT *, CASE WHEN event_id % 31 = 0 THEN 'null_key' WHEN event_id % 29 = 0 THEN 'parts'
  WHEN event_id % 23 = 0 THEN 'number' END AS bad FROM {Q.PINGS})""")
def composite_keys(spark, d):
    e = F.col("event_id")
    key = (F.when(e % 31 == 0, F.lit(None)).when(e % 29 == 0, F.concat_ws("|", "driver_id", F.lit("40.7")))
           .when(e % 23 == 0, F.concat_ws("|", "driver_id", F.lit("north"), F.col("lon").cast("string")))
           .otherwise(C.composite_key("driver_id", "lat", "lon")))
    return _outcome(C.parse_composite_key(I.pings(spark, d).select("event_id", key.alias("key"))), "event_id", "entity_id", "lat", "lon")


def _prefix(q: int) -> int:
    return (7 << 52) | (q << 26)


PREFIX_LOW, PREFIX_HIGH = _prefix((1 << 25) - 5035), _prefix((1 << 25) - 5028)


@query("state_prefix_scan", f"""SELECT cell, driver_id, event_id, status FROM {Q.latest(Q.with_cell(Q.PINGS, 7), 'cell, driver_id')}
  WHERE cell BETWEEN {PREFIX_LOW} AND {PREFIX_HIGH}""")
def state_prefix_scan(spark, d):
    rows = P.with_cell(I.pings(spark, d), 7).select("cell", "driver_id", "event_id", "status")
    path = scratch_path(spark, "state")
    writers.write_state(state.latest_per_cell_driver(rows, "event_id"), path)
    return writers.scan_state(spark, path, PREFIX_LOW, PREFIX_HIGH)


@query("union_of_topics", f"""SELECT 'drivers' AS topic, driver_id, NULL::VARCHAR AS rider_id, ts_ms FROM {Q.PINGS}
  UNION ALL SELECT 'riders', NULL, rider_id, request_ms FROM {Q.RIDERS}""")
def union_of_topics(spark, d):
    return readers.union_topics({"drivers": I.pings(spark, d).select("driver_id", "ts_ms"),
                                 "riders": I.riders(spark, d).select("rider_id", F.col("request_ms").alias("ts_ms"))})


@query("topic_totals", """SELECT topic, count(*) AS records FROM (SELECT 'drivers' AS topic FROM events UNION ALL SELECT 'riders' FROM orders) GROUP BY ROLLUP (topic)""")
def topic_totals(spark, d):
    return metrics.topic_totals(readers.union_topics({"drivers": I.table(spark, d, "events").select("event_id"),
                                                      "riders": I.table(spark, d, "orders").select("o_orderkey")}))


def _sink_sql() -> str:
    from .matches import _same_cell_sql
    return f"SELECT rider_id, driver_id, cell, latency_ms FROM ({_same_cell_sql()})"


@query("matches_sink", _sink_sql())
def matches_sink(spark, d):
    from .matches import match_same_cell
    path = scratch_path(spark, "matches")
    matches = match_same_cell(spark, d)
    writers.write_matches(matches, path)
    return spark.read.schema(matches.schema).parquet(path)


@query("metrics_document", f"""SELECT concat('{{', chr(10), '  "status" : "', status, '",', chr(10), '  "total_records" : ', CAST(count(*) AS VARCHAR), ',', chr(10),
  '  "drivers" : ', CAST(count(DISTINCT driver_id) AS VARCHAR), chr(10), '}}') AS document FROM {Q.PINGS} GROUP BY status""")
def metrics_document(spark, d):
    report = I.pings(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("total_records"), F.count_distinct("driver_id").alias("drivers"))
    return writers.report_document(report)


@query("metrics_report_file", f"SELECT status, count(*) AS total_records FROM {Q.PINGS} GROUP BY status")
def metrics_report_file(spark, d):
    report = I.pings(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("total_records"))
    path = scratch_path(spark, "report")
    writers.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


_CODEC = f"""(SELECT codec, count(*) AS events, CAST(sum(strlen(payload)) AS BIGINT) AS raw_bytes, 10.0e0 AS run_seconds FROM {Q.RUNS} GROUP BY codec)"""


@query("codec_report", f"""SELECT *, raw_bytes / compressed_bytes AS ratio, CAST(floor(events / run_seconds) AS BIGINT) AS events_per_sec,
  CAST(floor(compressed_bytes / run_seconds) AS BIGINT) AS bytes_per_sec, (1.0e0 - 1.0e0 / (raw_bytes / compressed_bytes)) * 100.0e0 AS saving_pct
  FROM (SELECT *, CAST(floor(raw_bytes / CASE codec WHEN 'lz4' THEN 3.0e0 WHEN 'snappy' THEN 2.5e0 WHEN 'gzip' THEN 6.5e0 ELSE 1.0e0 END) AS BIGINT) AS compressed_bytes FROM {_CODEC})""")
def codec_report(spark, d):
    return metrics.codec_report(I.run_table(spark, d))


# ---- validation and projections -------------------------------------------

_REASON = "CASE WHEN trim(driver_id) = '' THEN 'blank_id' WHEN lat NOT BETWEEN -90 AND 90 THEN 'lat_range' WHEN lon NOT BETWEEN -180 AND 180 THEN 'lon_range' END"


@query("validate_pings", f"SELECT event_id, {_REASON} AS reason FROM {Q.FLAWED}")
def validate_pings(spark, d):
    return P.validate_pings(I.flawed_pings(spark, d), on_bad="reason").select("event_id", "reason")


@query("range_guard", f"SELECT event_id, {_REASON} IS NULL AS in_range, CASE WHEN {_REASON} IS NULL THEN CAST(abs(cell) % 64 AS INTEGER) ELSE 0 END AS partition FROM {Q.with_cell(Q.FLAWED, 3)}")
def range_guard(spark, d):
    guarded = P.validate_pings(P.with_cell(I.flawed_pings(spark, d), 3), on_bad="default")
    return guarded.select("event_id", "in_range", F.when(F.col("in_range"), partition_of("mod", 64)).otherwise(F.lit(0)).alias("partition"))


@query("validate_drivers", f"""SELECT event_id, CASE WHEN event_id % 16 <> 9 THEN 'resolution' WHEN (event_id % 401) - 20 < 0 OR (event_id % 401) - 20 >= 360 THEN 'heading'
  WHEN CAST(user_id % 40 AS DOUBLE) > 33.3e0 THEN 'speed' END AS reason FROM {Q.H3_IDS}""")
def validate_drivers(spark, d):
    drivers = I.h3_ids(spark, d).withColumns({"heading": (F.col("event_id") % 401) - 20, "speed_mps": (F.col("user_id") % 40).cast("double")})
    return P.validate_drivers(drivers, on_bad="reason").select("event_id", "reason")


def _valid_cells_sql() -> str:
    from .cells import _VALID
    return f"SELECT event_id, cell FROM {_VALID} WHERE is_valid"


@query("filter_valid_cell", _valid_cells_sql())
def filter_valid_cell(spark, d):
    return P.filter_valid_cell(I.h3_ids(spark, d)).select("event_id", "cell")


@query("drop_null_values", f"SELECT event_id, driver_id, lat FROM {Q.PINGS} WHERE event_id % 7 <> 0 AND event_id % 5 <> 0")
def drop_null_values(spark, d):
    e = F.col("event_id")
    holes = I.pings(spark, d).select("event_id", F.when(e % 7 != 0, F.col("driver_id")).alias("driver_id"), F.when(e % 5 != 0, F.col("lat")).alias("lat"))
    return P.drop_nulls(holes, ["driver_id", "lat"])


@query("available_only", f"SELECT event_id, driver_id FROM {Q.PINGS} WHERE status = 'AVAILABLE'")
def available_only(spark, d):
    return P.available_only(I.pings(spark, d)).select("event_id", "driver_id")


@query("ping_cells", f"SELECT event_id, driver_id, cell FROM {Q.with_cell(Q.PINGS, 9)}")
def ping_cells(spark, d):
    return P.with_cell(I.pings(spark, d), 9).select("event_id", "driver_id", "cell")


@query("rekey_by_cell", f"SELECT cell AS key, count(*) AS records FROM {Q.with_cell(Q.PINGS, 7)} GROUP BY 1")
def rekey_by_cell(spark, d):
    return P.rekey(P.with_cell(I.pings(spark, d), 7), "cell").groupBy("key").agg(F.count(F.lit(1)).alias("records"))


@query("peek_counters", f"SELECT event_id, status FROM {Q.PINGS}")
def peek_counters(spark, d):
    return P.with_counters(I.pings(spark, d), "pings_seen", rows=F.count(F.lit(1)),
                           available=F.count_if(F.col("status") == "AVAILABLE")).select("event_id", "status")


@query("peek_counter_values", f"SELECT count(*) AS rows, count(*) FILTER (status = 'AVAILABLE') AS available, count(DISTINCT driver_id) AS drivers FROM {Q.PINGS}")
def peek_counter_values(spark, d):
    """What the counters saw while the pings were written elsewhere."""
    path = scratch_path(spark, "peeked")
    seen = {"rows": F.count(F.lit(1)), "available": F.count_if(F.col("status") == "AVAILABLE"), "drivers": F.size(F.collect_set("driver_id")).cast("bigint")}
    return P.counted_run(I.pings(spark, d), lambda rows: rows.write.parquet(path), **seen)


@query("outcome_folders", f"""SELECT outcome, reason, count(*) AS records, count(driver_id) AS parsed FROM (SELECT CASE WHEN event_id % 97 = 0 THEN 'quarantine' ELSE 'good' END AS outcome,
  CASE WHEN event_id % 97 = 0 THEN 'unparsable' END AS reason, CASE WHEN event_id % 97 <> 0 THEN driver_id END AS driver_id FROM {Q.PINGS}) GROUP BY ALL""")
def outcome_folders(spark, d):
    """Both outcomes of a decoded table, written in one pass."""
    path = scratch_path(spark, "outcomes")
    writers.write_outcomes(C.decode_json(_json_raw(spark, d)).rows, path)
    return spark.read.parquet(path).groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("records"), F.count("driver_id").alias("parsed"))


def _json_folder(spark, d, label):
    path = scratch_path(spark, label)
    _json_raw(spark, d).select("value").write.text(path)
    return path


@query("read_pings_folder", f"SELECT driver_id, lat, lon, ts_ms, status FROM {Q.PINGS} WHERE event_id % 97 <> 0")
def read_pings_folder(spark, d):
    """Pings read from a folder of text files by the reader that decodes them."""
    return readers.read_pings(spark, _json_folder(spark, d, "ping-files")).good


@query("read_pings_quarantine", f"SELECT count(*) AS records, 'unparsable' AS reason FROM {Q.PINGS} WHERE event_id % 97 = 0")
def read_pings_quarantine(spark, d):
    bad = readers.read_pings(spark, _json_folder(spark, d, "ping-files")).quarantine
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


@query("read_topics_folders", f"""SELECT 'drivers' AS topic, driver_id AS id, count(*) AS records, max(ts_ms) AS last_ms FROM {Q.PINGS} GROUP BY driver_id
  UNION ALL SELECT 'riders', rider_id, count(*), max(request_ms) FROM {Q.RIDERS} GROUP BY rider_id""")
def read_topics_folders(spark, d):
    """Payloads of two sources, read from the earliest on and tagged by source."""
    folders = {name: scratch_path(spark, f"topic-{name}") for name in ("drivers", "riders")}
    I.pings(spark, d).select(C.encode_csv("ping").alias("value")).write.text(folders["drivers"])
    I.riders(spark, d).select(C.encode_csv("rider").alias("value")).write.text(folders["riders"])
    part = F.split("value", ",")
    read = readers.read_topics(spark, folders).select("topic", part[0].alias("id"), part[3].cast("bigint").alias("ms"))
    return read.groupBy("topic", "id").agg(F.count(F.lit(1)).alias("records"), F.max("ms").alias("last_ms"))


@query("normalize_variants", f"""SELECT 'short' AS variant, driver_id, lat, lon, ts_ms, cell, NULL::DOUBLE AS speed_mps FROM {Q.with_cell(Q.PINGS, 9)}
  UNION ALL SELECT 'kinematic_kmh', driver_id, lat, lon, ts_ms, NULL, CAST(user_id % 120 AS DOUBLE) * {Q.num(1.0 / 3.6)} FROM {Q.PINGS}
  UNION ALL SELECT 'kinematic_mph', CAST(user_id AS VARCHAR), lat, lon, ts_ms, NULL, CAST(user_id % 120 AS DOUBLE) * {Q.num(0.44704)} FROM {Q.PINGS}
  UNION ALL SELECT 'hex', driver_id, lat, lon, ts_ms, cell, NULL FROM {Q.with_cell(Q.PINGS, 7)}""")
def normalize_variants(spark, d):
    p = I.pings(spark, d)
    speed = (F.col("user_id") % 120).cast("int")
    shapes = {
        "short": P.with_cell(p, 9).select(F.col("driver_id").alias("driverId"), "lat", F.col("lon").alias("lng"), F.col("cell").alias("h3Cell"), F.col("ts_ms").alias("timestampMs")),
        "kinematic_kmh": p.select(F.col("driver_id").alias("driverId"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.col("ts_ms").alias("timestamp"), speed.alias("speedKmh")),
        "kinematic_mph": p.select(F.col("user_id").alias("driverId"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.col("ts_ms").alias("timestamp"), speed.alias("speed")),
        "hex": P.with_cell(p, 7).select(F.col("driver_id").alias("driverId"), "lat", "lon", F.lower(F.hex("cell")).alias("h3Cell"), F.col("ts_ms").alias("timestampMs")),
    }
    wanted = ["driver_id", "lat", "lon", "ts_ms", "cell", "speed_mps"]
    out = None
    for variant, raw in shapes.items():
        part = P.normalize_pings(raw, variant).withColumn("variant", F.lit(variant))
        part = part.select("variant", *[F.col(c) if c in part.columns else F.lit(None).cast("bigint" if c == "cell" else "double").alias(c) for c in wanted])
        out = part if out is None else out.unionByName(part)
    return out


@query("event_latency", f"SELECT event_id, 1706745600000 - ts_ms AS latency_ms FROM {Q.PINGS}")
def event_latency(spark, d):
    return I.pings(spark, d).select("event_id", latency_ms(F.lit(1706745600000), "ts_ms").alias("latency_ms"))


@query("padded_ids", f"SELECT event_id, concat('driver-', CASE WHEN user_id < 100000 THEN lpad(CAST(user_id AS VARCHAR), 5, '0') ELSE CAST(user_id AS VARCHAR) END) AS padded FROM {Q.PINGS}")
def padded_ids(spark, d):
    return I.pings(spark, d).select("event_id", padded_id("user_id").alias("padded"))


@query("half_up_rounding", "SELECT l_orderkey, l_linenumber, floor(l_extendedprice * l_discount * 100.0e0 + 0.5e0) / 100.0e0 AS rounded FROM lineitem")
def half_up_rounding(spark, d):
    return I.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", round2(F.col("l_extendedprice") * F.col("l_discount")).alias("rounded"))


@query("json_round_trip", f"SELECT event_id, driver_id, lat, lon, ts_ms, status FROM {Q.PINGS}")
def json_round_trip(spark, d):
    raw = I.pings(spark, d).select("event_id", C.encode_json("driver_id", "lat", "lon", "ts_ms", "status").alias("value"))
    return C.decode_json(raw, PING).good.select(*WIRE)

