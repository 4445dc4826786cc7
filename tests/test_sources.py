"""Codecs, quarantine, readers and writers."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from fleetgrid.sources import codecs, readers, writers


def test_bad_json_is_kept(spark, tmp_path):
    good = '{"driver_id":"a","lat":1.5,"lon":2.5,"ts_ms":7,"status":"AVAILABLE"}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.txt").write_text("\n".join([good, "{broken", good.replace("1.5", '"north"')]))
    out = readers.read_pings(spark, str(tmp_path / "in"))
    assert out.good.count() == 1 and out.quarantine.count() == 2
    assert sorted(r.value[:7] for r in out.quarantine.collect()) == [good[:7], "{broken"]


def test_binary_layouts_match_struct(spark):
    df = spark.createDataFrame([("dé", 40.7128, -74.006, 99, 1700000000000, "ON_TRIP")], "driver_id string, lat double, lon double, cell bigint, ts_ms bigint, status string")
    payload = bytes(codecs.encode_binary(df, "lp_ping").first().value)
    assert payload == struct.pack(">i", 3) + "dé".encode() + struct.pack(">ddqq", 40.7128, -74.006, 99, 1700000000000)
    payload = bytes(codecs.encode_binary(df, "lp_status").first().value)
    assert payload == struct.pack(">ddq", 40.7128, -74.006, 1700000000000) + struct.pack(">i", 7) + b"ON_TRIP" + struct.pack(">i", 3) + "dé".encode()
    fixed = codecs.encode_binary(df.withColumn("driver_id", F.lit(-5)), "fixed28")
    assert bytes(fixed.first().value) == struct.pack(">iddq", -5, 40.7128, -74.006, 1700000000000)
    moving = codecs.encode_binary(df.withColumns({"heading": F.lit(1.5), "speed_mps": F.lit(0.1)}), "fixed40")
    assert bytes(moving.first().value) == struct.pack(">qddff8x", 1700000000000, 40.7128, -74.006, 1.5, 0.1)


def test_damaged_binary_is_quarantined(spark):
    whole = struct.pack(">i", 1) + b"a" + struct.pack(">ddqq", 1.0, 2.0, 3, 4)
    payloads = [whole, whole[:-1], whole + b"x", struct.pack(">i", -1) + whole[4:], struct.pack(">i", 2**31 - 1) + whole[4:], b"", b"\x00", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, value binary")
    out = codecs.decode_binary(df, "lp_ping")
    assert [tuple(r) for r in out.good.collect()] == [(0, "a", 1.0, 2.0, 3, 4)]
    assert sorted(r.i for r in out.quarantine.collect()) == [1, 2, 3, 4, 5, 6, 7]
    two = spark.createDataFrame([(struct.pack(">i", 2**31 - 1) * 6,)], "value binary")
    assert codecs.decode_binary(two, "lp_match").quarantine.count() == 1


def test_composite_keys(spark):
    df = spark.createDataFrame([("a|1.5|-2",), ("a|1.5",), ("a|x|2",), (None,), ("a|1|2|3",)], "key string")
    out = codecs.parse_composite_key(df)
    assert [tuple(r) for r in out.good.collect()] == [("a|1.5|-2", "a", 1.5, -2.0)]
    assert sorted(r.reason for r in out.quarantine.collect()) == ["null_key", "number", "number", "parts"]


def test_csv_has_six_decimals(spark):
    df = spark.createDataFrame([("a", 1.23456789, -2.0, 5, "OFFLINE")], "driver_id string, lat double, lon double, ts_ms bigint, status string")
    text = df.select(codecs.encode_csv("ping").alias("value"))
    assert text.first().value == "a,1.234568,-2.000000,5,OFFLINE"
    assert tuple(codecs.decode_csv(text, "ping").good.first()) == ("a", 1.234568, -2.0, 5, "OFFLINE")


def test_topics_are_tagged(spark, tmp_path):
    for name, lines in (("drivers", 3), ("riders", 2)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.txt").write_text("\n".join("x" * lines))
    both = readers.read_topics(spark, {n: str(tmp_path / n) for n in ("drivers", "riders")})
    assert sorted((r.topic, r["count"]) for r in both.groupBy("topic").count().collect()) == [("drivers", 3), ("riders", 2)]


def test_state_is_sorted_and_ranges_reach_the_scan(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("cell"), F.concat(F.lit("d"), F.col("id")).alias("driver_id"))
    path = str(tmp_path / "state")
    # re-planning would rightly merge files this small
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_state(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = writers.scan_state(spark, path, 100, 199)
    assert found.count() == df.filter("cell BETWEEN 100 AND 199").count()
    plan = found._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(cell,100)" in plan and "LessThanOrEqual(cell,199)" in plan
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min("cell").alias("lo"), F.max("cell").alias("hi")).orderBy("lo").collect()
    assert len(spans) > 1 and all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))


def test_report_is_json(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5)], "n int, rate double")
    assert json.loads(writers.report_document(df).first().document) == {"n": 1, "rate": 2.5}
    writers.write_report(df, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().rate == 2.5


def test_a_run_written_twice_counts_once(spark, tmp_path):
    sink, rows = str(tmp_path / "matches"), spark.createDataFrame([("r1", "d1"), ("r2", "d2")], "rider_id string, driver_id string")
    writers.write_matches(rows, sink, run="2024-01-01 08:00")
    writers.write_matches(rows.limit(1), sink, run="2024-01-02")
    writers.write_matches(rows, sink, run="2024-01-01 08:00")
    assert sorted(r.rider_id for r in spark.read.parquet(sink).collect()) == ["r1", "r1", "r2"]
    with pytest.raises(ValueError):
        writers.write_matches(rows, {"topic": "matches"}, run="2024-01-02")
