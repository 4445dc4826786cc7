"""Streams fed file by file, compared with the rule and with a restart in between."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fleetgrid.streaming import jobs, processors
from fleetgrid.sources.readers import read_pings, read_table_stream, write_slices
from fleetgrid.sources.writers import start, write_matches

PING = "driver_id string, event_id bigint, ts_ms bigint"


def feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_dedup_across_batches_and_a_restart(spark, tmp_path):
    src, out, progress = (str(tmp_path / n) for n in ("src", "out", "progress"))
    jobs.use_rocksdb(spark)

    def run():
        kept = processors.dedup_stream(stream(spark, src, PING))
        start(kept.writeStream.format("parquet").option("path", out), progress).awaitTermination()
        return [(r.driver_id, r.event_id) for r in spark.read.parquet(out).orderBy("event_id").collect()]

    # arrival order inside a batch is the event id, not the order in the file
    feed(spark, src, [("a", 2, 1), ("a", 1, 1), ("b", 3, 5)], PING)
    assert run() == [("a", 1), ("b", 3)]
    feed(spark, src, [("a", 4, 1), ("a", 5, 2), ("b", 6, 5)], PING)
    feed(spark, src, [("a", 7, 1), ("c", 8, 1)], PING)
    assert run() == [("a", 1), ("b", 3), ("a", 5), ("a", 7), ("c", 8)]


def test_dedup_in_batches_across_a_restart(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "base")

    def run():
        jobs.dedup_in_batches(stream(spark, src, PING), base).awaitTermination()
        return [(r.driver_id, r.event_id) for r in spark.read.parquet(f"{base}/out").orderBy("event_id").collect()]

    feed(spark, src, [("a", 2, 1), ("a", 1, 1), ("b", 3, 5)], PING)
    assert run() == [("a", 1), ("b", 3)]
    feed(spark, src, [("a", 4, 1), ("a", 5, 2), ("b", 6, 5)], PING)
    feed(spark, src, [("a", 7, 1), ("c", 8, 1)], PING)
    assert run() == [("a", 1), ("b", 3), ("a", 5), ("a", 7), ("c", 8)]


def test_a_slice_of_many_files_is_one_batch(spark, tmp_path):
    path, base = str(tmp_path / "in"), str(tmp_path / "base")
    # the third slice has one row only, and the fourth none but the last
    rows = spark.range(1, 2001).union(spark.createDataFrame([(2500,), (4000,)], "id long")).coalesce(1)
    files = write_slices(rows, path, "id", 4, file_rows=150)
    assert files == 7 and len(list((tmp_path / "in").glob("part-*.parquet"))) == 4 * files
    taken = read_table_stream(spark, path, "part-", rows.schema, files)
    start(taken.writeStream.foreachBatch(lambda df, n: df.write.parquet(f"{base}/batch={n}")), f"{base}-progress").awaitTermination()
    seen = spark.read.parquet(base).groupBy("batch").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    assert sorted(map(tuple, seen.collect())) == [(0, 1000, 1, 1000), (1, 1000, 1001, 2000), (2, 1, 2500, 2500), (3, 1, 4000, 4000)]


def test_plain_and_nullable_numbers_drop_the_same_repeats():
    rng = np.random.default_rng(6)
    for n in (1, 2, 7, 300):
        rows = pd.DataFrame({"ts": rng.integers(0, 4, n), "event_id": rng.integers(0, n, n), "copy": rng.integers(0, 2, n), "clock": rng.integers(0, 6, n)})
        for ttl, clock in ((None, None), (2, "clock"), (2, 4)):
            for before in (None, 1):
                p = processors.DropRepeats("ts", ["event_id", "copy"], ttl, clock if isinstance(clock, str) else None, False, list(rows))
                whole = processors._whole(rows, ["ts", "event_id", "copy", *(["clock"] if clock == "clock" else [])])
                fast, last = p._fresh(whole, before, clock)
                slow, end = p._fresh_with_nulls(rows, before, clock)
                assert fast.tolist() == slow.tolist() and last == end
    assert processors._whole(pd.DataFrame({"ts": [1.0, None]}), ["ts"]) is None


def test_both_outcomes_from_one_query_across_a_restart(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "base")
    schema, good, bad = "driver_id string, event_id bigint, cell bigint", 0x892A1072B43FFFF, 5

    def run(batches):
        query = jobs.process_to_tables(stream(spark, src, schema), "event_id", base)
        query.awaitTermination()
        forwarded = sorted((r.event_id, r.key) for r in spark.read.parquet(f"{base}/forwarded").collect())
        state = jobs.driver_state(spark, base, spark.read.parquet(src).schema, batches).collect()
        return forwarded, sorted((r.driver_id, r.event_id) for r in state)

    feed(spark, src, [("a", 2, good), ("a", 1, good), ("b", 3, good), ("c", 4, bad)], schema)
    assert run(1) == ([(1, good), (2, good), (3, good)], [("a", 2), ("b", 3)])
    for i in range(5, 14):  # more batches than are kept apart
        feed(spark, src, [("a", i, good if i % 2 else bad)], schema)
    forwarded, state = run(10)
    assert [n for n, _ in forwarded] == [1, 2, 3, 5, 7, 9, 11, 13] and state == [("a", 13), ("b", 3)]


def test_riders_meet_the_last_driver_before_them(spark, tmp_path):
    schema = "cell bigint, kind string, arrival bigint, driver_id string, status string, rider_id string"
    src = str(tmp_path / "src")
    feed(spark, src, [(1, "rider", 1, None, None, "r1"), (1, "driver", 2, "a", "AVAILABLE", None), (1, "rider", 3, None, None, "r3"), (2, "driver", 4, "b", "OFFLINE", None)], schema)
    feed(spark, src, [(1, "rider", 5, None, None, "r5"), (1, "driver", 6, "c", "OFFLINE", None), (1, "rider", 7, None, None, "r7"), (2, "rider", 8, None, None, "r8")], schema)
    out = jobs.run_to_table(processors.match_same_cell_stream(stream(spark, src, schema)), "match")
    assert sorted((r.rider_id, r.driver_id, r.cell) for r in out.collect()) == [("r3", "a", 1), ("r5", "a", 1)]


def test_match_in_batches_keeps_the_state_between_them(spark, tmp_path):
    schema = "cell bigint, kind string, arrival bigint, driver_id string, status string, rider_id string"
    src, base = str(tmp_path / "src"), str(tmp_path / "base")
    feed(spark, src, [(1, "driver", 2, "a", "AVAILABLE", None), (1, "rider", 1, None, None, "r1"), (1, "rider", 3, None, None, "r3")], schema)
    feed(spark, src, [(2, "driver", 4, "b", "AVAILABLE", None)], schema)

    def run():
        jobs.match_in_batches(stream(spark, src, schema), base).awaitTermination()
        return sorted((r.rider_id, r.driver_id) for r in spark.read.parquet(f"{base}/out").collect())

    assert run() == [("r3", "a")]
    feed(spark, src, [(1, "rider", 5, None, None, "r5"), (1, "driver", 6, "c", "OFFLINE", None), (1, "rider", 7, None, None, "r7")], schema)
    feed(spark, src, [(2, "rider", 8, None, None, "r8")], schema)
    assert run() == [("r3", "a"), ("r5", "a"), ("r8", "b")]


def test_bad_records_of_a_stream_reach_the_quarantine(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text('{"driver_id":"a","lat":1.0,"lon":2.0,"ts_ms":1,"status":"OFFLINE"}\n{oops\n')
    for side, count in (("good", 3), ("quarantine", 3)):
        rows = getattr(read_pings(spark, str(tmp_path / "in"), streaming=True, max_per_trigger=1), side)
        writer = write_matches(rows, str(tmp_path / side), checkpoint=str(tmp_path / f"{side}-progress"))
        start(writer, str(tmp_path / f"{side}-progress")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / side)).count() == count


def test_cumulative_counts_are_emitted_in_full_each_time(spark, tmp_path):
    schema, src = "partition int, lat double", str(tmp_path / "src")
    feed(spark, src, [(0, 45.0), (1, 45.0)], schema)
    feed(spark, src, [(0, 45.0)], schema)
    seen = []
    query = jobs.band_counts_stream(stream(spark, src, schema), "p", None, lambda df, n: seen.append(sorted((r.partition, r.records) for r in df.collect())), str(tmp_path / "progress"))
    query.awaitTermination()
    assert seen[-1] == [(0, 2), (1, 1)] and len(seen) == 2


def test_ping_processing_forwards_all_and_keeps_the_last(spark, tmp_path):
    valid, src = int("892a1072b43ffff", 16), str(tmp_path / "src")
    schema = "driver_id string, event_id bigint, cell bigint"
    feed(spark, src, [("a", 1, valid), ("a", 2, valid), ("a", 3, 5), ("b", 4, 6157323354570604543)], schema)
    forwarded, state = jobs.process_pings(stream(spark, src, schema), "event_id")
    assert sorted(r.event_id for r in jobs.run_to_table(forwarded, "f").collect()) == [1, 2]
    assert [(r.driver_id, r.event_id) for r in jobs.run_to_table(state, "s", "update").collect()] == [("a", 2)]


def test_a_repeat_passes_once_the_stored_time_has_expired(spark, tmp_path):
    src, schema = str(tmp_path / "src"), "driver_id string, event_id bigint, ts_ms bigint, at_ms bigint"
    big = 1_700_000_000_000_000_001  # beyond what a double holds
    feed(spark, src, [("a", 1, 1000, 1000), ("a", 2, 1000, 2000), ("b", 3, big, big), ("b", 4, big + 1, big), ("b", 5, big + 1, big)], schema)
    feed(spark, src, [("a", 6, 1000, 11_000), ("a", 7, 1000, 11_001), ("a", 8, 1000, 11_002), ("c", 9, None, 5), ("c", 10, None, 6)], schema)
    kept = jobs.run_to_table(processors.dedup_stream(stream(spark, src, schema), ttl_ms=10_000, clock="at_ms"), "ttl")
    # 6 is as old as the limit allows; 7 and 8 find a void entry, because passing with the same time renews nothing
    assert sorted(r.event_id for r in kept.collect()) == [1, 3, 4, 7, 8, 9, 10]


def test_negative_order_numbers_and_nulls_in_batches(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "base")
    feed(spark, src, [("a", -5, 1), ("a", -9, 1), (None, -1, 7)], PING)
    feed(spark, src, [("a", -20, 1), ("a", -19, 2), (None, -30, 7), (None, 4, 8)], PING)
    feed(spark, src, [("a", -50, 2), ("b", 0, 1)], PING)
    jobs.dedup_in_batches(stream(spark, src, PING), base).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(f"{base}/out").collect()) == [-19, -9, -1, 0, 4]


def test_binary_payloads_are_read_as_they_are(spark, tmp_path):
    from fleetgrid.sources.codecs import encode_binary
    row = "SELECT 'a\n\u00e9' AS rider_id, 10.0D AS lat, -0.1D AS lon, 720575940379279370L AS cell, 10L AS ts_ms"
    for i in range(2):
        payload = encode_binary(spark.sql(row), "lp_rider").first().value
        assert b"\n" in payload and max(payload) > 0x7F
        (tmp_path / f"{i}.bin").write_bytes(payload)
    (tmp_path / "bad.bin").write_bytes(b"\x00\x01")
    got = read_pings(spark, str(tmp_path), "lp_rider")
    assert [tuple(r) for r in got.good.collect()] == [("a\n\u00e9", 10.0, -0.1, 720575940379279370, 10)] * 2
    assert got.quarantine.count() == 1


def test_state_leaves_when_its_time_is_over(spark, tmp_path):
    src, base, schema = str(tmp_path / "src"), str(tmp_path / "base"), "driver_id string, event_id bigint, ts_ms bigint"
    feed(spark, src, [("a", 1, 1_000), ("b", 2, 1_500), ("c", 3, None)], schema)
    feed(spark, src, [("a", 4, 5_000), ("d", 5, 5_000)], schema)
    feed(spark, src, [("d", 6, 9_000), ("d", 7, 9_000)], schema)
    kept = processors.dedup_stream(stream(spark, src, schema), ttl_ms=2_000, clock="ts_ms", lateness="0 seconds")
    out = jobs.run_to_table(kept, "evicted", base=base)
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3, 4, 5, 6]
    live = jobs.live_state(spark, f"{base}/progress", "last", 4).collect()
    # a missing time is never stored; 1,500 is over once the watermark has reached 5,000, and 5,000 at 9,000
    assert sorted((r.batch, r.driver_id, r.ts) for r in live) == [(0, "a", 1000), (0, "b", 1500), (1, "a", 5000), (1, "b", 1500), (1, "d", 5000), (2, "a", 5000), (2, "d", 9000), (3, "d", 9000)]


def test_folders_that_a_batch_reads_stay_few():
    for fan in (2, 3, 8):
        for n in range(300):
            found = jobs.covering(n, fan)
            held = [last - i for level, last in found for i in range(fan ** level)]
            assert sorted(held) == list(range(n)) and len(found) <= (fan - 1) * 9
    assert max(len(jobs.covering(n)) for n in range(512)) <= 7 * 3


def test_merged_state_over_many_batches(spark, tmp_path):
    import os
    src, base = str(tmp_path / "src"), str(tmp_path / "base")
    schema = "driver_id string, event_id bigint, ts_ms bigint, batch string"
    rows = [(f"d{(i * 7) % 5}" if i % 11 else None, i, (i // 6) % 4, "mine") for i in range(36)]
    for i in range(0, 36, 4):
        feed(spark, src, rows[i:i + 4], schema)
    jobs.dedup_in_batches(stream(spark, src, schema), base, fan=2).awaitTermination()
    last, want = {}, []
    for key, i, ts, _ in rows:
        if key not in last or last[key] != ts:
            want.append(i)
        last[key] = ts
    out = spark.read.schema(schema.replace(", batch string", "")).parquet(f"{base}/out")
    assert sorted(r.event_id for r in out.collect()) == want
    # nine batches: eight are in one folder, and the folders merged before the last batch are gone
    assert sorted(os.listdir(f"{base}/state")) == ["0-8", "3-7"]


def test_streams_at_timed_triggers(spark, tmp_path):
    src, schema = str(tmp_path / "src"), "driver_id string, event_id bigint, ts_ms bigint"
    for i in range(3):
        feed(spark, src, [("a", i, i)], schema)
    counts = stream(spark, src, schema).groupBy("driver_id").count()
    out = jobs.run_to_table(counts, "timed", "complete", every="200 milliseconds")
    assert sorted((r.batch, r["count"]) for r in out.collect()) == [(0, 1), (1, 2), (2, 3)]


def test_scratch_tables_have_an_owner(spark):
    import os
    from fleetgrid import session
    with session.scratch_area(spark):
        path = session.scratch_path(spark, "owned")
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path)
    assert not os.path.isdir(path)
