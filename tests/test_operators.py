"""Operators on hand-made rows and against brute force."""

import math
import random

import pytest
from pyspark.sql import Window, functions as F

from fleetgrid.functions import binary
from fleetgrid.functions.grid import axial_q, axial_r, cell_of, grid_disk, seam_columns
from fleetgrid.operators import boundary, matching, metrics, nearest, ordered, partitioning, quality, series, skew, state
from fleetgrid.operators.percentiles import pctl


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- validation ------------------------------------------------------------

def test_validation_keeps_every_row(spark):
    rows = [("a", 1.0, 2.0), (" ", 1.0, 2.0), (None, 1.0, 2.0), ("b", 90.1, 2.0), ("c", 1.0, -180.5), ("d", None, 1.0), ("e", -90.0, 180.0)]
    good, bad = quality.validate_pings(spark.createDataFrame(rows, "driver_id string, lat double, lon double"))
    assert [r.driver_id for r in good.collect()] == ["a", "e"]
    assert sorted(r.reason for r in bad.collect()) == ["blank_id", "blank_id", "lat_range", "lat_range", "lon_range"]


def test_driver_limits(spark):
    nine = int("892a1072b43ffff", 16)
    rows = [(nine, 0, 0.0), (nine, 359, 33.3), (nine, 360, 1.0), (nine, -1, 1.0), (nine, 5, 33.4), (int("872a1072fffffff", 16), 5, 1.0)]
    good, bad = quality.validate_drivers(spark.createDataFrame(rows, "cell bigint, heading int, speed_mps double"))
    assert good.count() == 2
    assert sorted(r.reason for r in bad.collect()) == ["heading", "heading", "resolution", "speed"]


# ---- partitions ------------------------------------------------------------

def test_published_partition_vectors(spark):
    cell = int("832830fffffffff", 16)
    df = spark.createDataFrame([(cell, "832830fffffffff")], "cell bigint, cell_hex string")
    row = df.select(*[partitioning.partition_of(m, 12).alias(m) for m in ("mod", "mod_abs", "fold_abs", "hex_fold_floor")]).first()
    assert (row["fold_abs"], row["hex_fold_floor"]) == (4, 8)
    assert row["mod"] == row["mod_abs"] == cell % 12


def test_city_points_stay_together(spark):
    points = [(lat / 7, lon / 3) for lat in range(-500, 501, 250) for lon in range(-450, 451, 300)]
    df = spark.createDataFrame([(a, b) for a, b in points for _ in range(2)], "lat double, lon double")
    placed = partitioning.assign_partition(df, "res4_fold_floor", 60)
    assert placed.groupBy("lat", "lon").agg(F.count_distinct("partition").alias("n")).filter("n > 1").count() == 0
    assert placed.filter("partition < 0 OR partition >= 60").count() == 0


def test_value_bytes_and_fallbacks(spark):
    df = spark.createDataFrame([(41.8781, -87.6298, "k"), (95.0, 0.0, "k")], "lat double, lon double, k string").withColumns({
        "value": F.concat(binary.put_f64("lat"), binary.put_f64("lon")), "key": F.encode("k", "UTF-8")})
    got = [r[0] for r in df.select(partitioning.partition_of("res3_unsigned", 64)).collect()]
    assert 0 <= got[0] < 64 and got[1] == 0
    short = df.withColumn("value", binary.put_f64("lat"))
    assert [r[0] for r in short.select(partitioning.partition_of("res3_unsigned", 64)).collect()] == [(31 + ord("k")) % 64] * 2
    assert short.withColumn("key", F.lit(None).cast("binary")).select(partitioning.partition_of("res3_unsigned", 64)).first()[0] == 0


def test_rows_without_a_cell_are_never_placed_at_random(spark):
    df = spark.createDataFrame([('{"h3Cell": 13}',), ('{"h3Cell": "x"}',), ("{",), (None,)], "payload string")
    assert [r[0] for r in df.select(partitioning.partition_of("json_mod", 12)).collect()] == [1, None, None, None]


def test_key_lengths(spark):
    df = spark.createDataFrame([(bytes(4), b"v"), (None, b"v"), (None, None)], "key binary, value binary")
    got = [r[0] for r in df.select(partitioning.partition_of("parent3_fold", 60)).collect()]
    assert all(0 <= p < 60 for p in got) and got[0] == got[1]


# ---- state and matching ----------------------------------------------------

def test_last_writer_hides_an_available_driver(spark):
    pings = spark.createDataFrame([(7, "a", "AVAILABLE", 1), (7, "b", "OFFLINE", 2), (8, "c", "AVAILABLE", 3)], "cell bigint, driver_id string, status string, event_id bigint")
    riders = spark.createDataFrame([("r1", 7), ("r2", 8), ("r3", 9)], "rider_id string, cell bigint")
    after = matching.match_same_cell(riders, pings)
    before = matching.match_same_cell(riders, pings, available="before")
    untested = matching.match_same_cell(riders, pings, available=None)
    assert rows_of(after) == [("r2", "c", 8)]
    assert rows_of(before) == [("r1", "a", 7), ("r2", "c", 8)]
    assert rows_of(untested) == [("r1", "b", 7), ("r2", "c", 8)]


def test_moved_drivers(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (1, "b", 3)], "cell bigint, driver_id string, event_id bigint")
    assert rows_of(state.latest_per_cell_driver(df, "event_id")) == [(1, "a", 1), (1, "b", 3), (2, "a", 2)]
    assert rows_of(state.latest_per_cell_driver(df, "event_id", evict_moved=True)) == [(1, "b", 3), (2, "a", 2)]


def test_misaligned_partitions_are_found(spark):
    a = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (3, 2)], "cell bigint, partition int")
    b = spark.createDataFrame([(1, 0), (2, 0), (4, 1)], "cell bigint, partition int")
    assert matching.copartition_summary(matching.copartition_check(a, b, 4, 4)).first() == (4, 1, 1, 2)
    assert matching.copartition_summary(matching.copartition_check(a, b, 4, 8)).first() == (4, 0, 2, 2)


def crowd(spark, seed, n_drivers, n_riders):
    """A third of all drivers and riders in one spot of a few hundred metres, some on identical positions."""
    rng = random.Random(seed)

    def place(hot):
        if hot:
            return 40.75 + rng.gauss(0, 0.0004), -73.98 + rng.gauss(0, 0.0004)
        return rng.uniform(40.70, 40.80), rng.uniform(-74.02, -73.94)

    drivers = [(f"d{i}", *place(i % 3 == 0)) for i in range(n_drivers)]
    drivers += [(f"c{i}", 40.7501, -73.9801) for i in range(200)]
    riders = [(f"r{i}", *place(i % 3 == 0)) for i in range(n_riders)] + [("at", 40.7501, -73.9801), ("far", 10.0, 10.0)]
    return (spark.createDataFrame(riders, "rider_id string, lat double, lon double"),
            spark.createDataFrame(drivers, "driver_id string, lat double, lon double"))


def brute_nearest(riders, drivers, resolution, k):
    from fleetgrid.functions.geo import haversine_km
    r = riders.withColumn("cell", F.explode(grid_disk(cell_of("lat", "lon", resolution), k)))
    d = drivers.select("driver_id", F.col("lat").alias("a"), F.col("lon").alias("b"), cell_of("lat", "lon", resolution).alias("cell"))
    pairs = r.join(d, "cell").withColumn("km", haversine_km("lat", "lon", "a", "b"))
    best = pairs.withColumn("n", F.row_number().over(Window.partitionBy("rider_id").orderBy("km", "driver_id"))).filter("n = 1")
    return best.select("rider_id", "driver_id", "km")


@pytest.mark.parametrize("leaf,few,seed", [(4, 0, 1), (32, 16, 2), (100000, 16, 3)])
def test_nearest_equals_brute_force(spark, monkeypatch, leaf, few, seed):
    monkeypatch.setattr(nearest, "FEW", few)
    riders, drivers = crowd(spark, seed, 2500, 600)
    got = nearest.match_nearest(riders, drivers, 9, 2, leaf_positions=leaf).select("rider_id", "driver_id", F.col("distance_km"))
    want = {r.rider_id: (r.driver_id, r.km) for r in brute_nearest(riders, drivers, 9, 2).collect()}
    found = {r.rider_id: (r.driver_id, r.distance_km) for r in got.collect()}
    assert found.keys() == want.keys() and "far" not in found
    assert all(found[k] == want[k] for k in want)


def test_nearest_compares_few_drivers_however_dense_a_cell_is(spark, monkeypatch):
    rng = random.Random(4)
    place = lambda: (40.7 + rng.uniform(0, 0.002), -74.0 + rng.uniform(0, 0.002))
    drivers = spark.createDataFrame([(f"d{i}", *place()) for i in range(12000)], "driver_id string, lat double, lon double")
    riders = spark.createDataFrame([(f"r{i}", *place()) for i in range(300)], "rider_id string, lat double, lon double")
    pairs, written, closest, materialise = [], [], nearest._closest, nearest.materialise
    monkeypatch.setattr(nearest, "_closest", lambda df: pairs.append(df.count()) or closest(df))
    monkeypatch.setattr(nearest, "materialise", lambda df, label: written.append(df.count() * (label == "frontier")) or materialise(df, label))
    got = {r.rider_id: (r.driver_id, r.distance_km) for r in nearest.match_nearest(riders, drivers, 9, 2).collect()}
    assert got == {r.rider_id: (r.driver_id, r.km) for r in brute_nearest(riders, drivers, 9, 2).collect()} and len(got) == 300
    assert sum(pairs) < 300 * 128 and sum(written) < 300 * 4, (pairs, written)


def test_nearest_where_drivers_crowd_a_corner_of_a_cell(spark):
    """A few spots of a cell hold nearly all of its drivers; riders stand among them and far from them."""
    rng = random.Random(5)
    tight = lambda: (40.7003 + rng.gauss(0, 2e-6), -74.0 + rng.gauss(0, 2e-6))
    wide = lambda: (40.7 + rng.uniform(-0.004, 0.004), -74.0 + rng.uniform(-0.004, 0.004))
    drivers = [(f"d{i}", *(tight() if i % 20 else wide())) for i in range(3000)]
    drivers += [("again", *drivers[7][1:]), (None, *wide()), ("nowhere", None, -74.0)]
    riders = [(f"r{i}", *(tight() if i % 3 else wide())) for i in range(200)] + [("none", None, None), ("far", 10.0, 10.0)]
    drivers = spark.createDataFrame(drivers, "driver_id string, lat double, lon double")
    riders = spark.createDataFrame(riders, "rider_id string, lat double, lon double")
    got = {r.rider_id: (r.driver_id, r.distance_km) for r in nearest.match_nearest(riders, drivers, 9, 2, leaf_positions=16).collect()}
    assert got == {r.rider_id: (r.driver_id, r.km) for r in brute_nearest(riders, drivers, 9, 2).collect()} and len(got) == 200


@pytest.mark.parametrize("leaf,few", [(4, 0), (100000, 16)])
def test_nearest_across_the_antimeridian(spark, monkeypatch, leaf, few):
    monkeypatch.setattr(nearest, "FEW", few)
    rng = random.Random(8)

    def place():
        lon = 180.0 + rng.gauss(0, 0.004)
        return rng.uniform(-17.01, -16.99), lon if lon < 180.0 else lon - 360.0

    drivers = [(f"d{i}", *place()) for i in range(400)] + [("over", 60.0, -179.9999), ("there", 20.0, 0.0)]
    riders = [(f"r{i}", *place()) for i in range(150)] + [("near", 60.0, 179.9999), ("edge", 20.0, 179.9)]
    to_df = lambda rows, who: spark.createDataFrame(rows, f"{who} string, lat double, lon double")
    got = {r.rider_id: (r.driver_id, r.distance_km) for r in nearest.match_nearest(
        to_df(riders, "rider_id"), to_df(drivers, "driver_id"), 9, 2, leaf_positions=leaf).collect()}
    assert got["near"][0] == "over" and got["near"][1] < 0.02 and "edge" not in got

    def cells(rows, who):
        return {r[0]: (r.q, r.r, r.lat, r.lon) for r in to_df(rows, who).withColumn("cell", cell_of("lat", "lon", 9)).select(
            who, axial_q("cell").alias("q"), axial_r("cell").alias("r"), "lat", "lon").collect()}

    def steps(a, b):
        return min(max(abs(a[0] - b[0] + t), abs(a[1] - b[1]), abs(a[0] - b[0] + t + a[1] - b[1])) for t in (0, seam_columns(9), -seam_columns(9)))

    def km(a, b):
        p, q = math.radians(a[2]), math.radians(b[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(h))

    at = cells(drivers, "driver_id")
    for rider, a in cells(riders, "rider_id").items():
        best = min(((km(a, b), d) for d, b in at.items() if steps(a, b) <= 2), default=None)
        assert (best is None) == (rider not in got)
        assert best is None or got[rider][0] == best[1] and abs(got[rider][1] - best[0]) < 1e-9


def test_latest_with_arrival_numbers_used_twice(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("b", 3, "z"), ("b", 2, "w"), ("c", 3, "v"), ("c", 3, "v"), (None, 1, "n"), (None, 5, "m"), ("d", None, "u"), ("e", 1, None)]
    df = spark.createDataFrame(rows, "driver_id string, event_id long, status string")
    got = {tuple(r) for r in state.latest_by(df, ["driver_id"], "event_id").collect()}
    assert got == {("a", 3, "y"), ("b", 3, "z"), ("c", 3, "v"), (None, 5, "m"), ("e", 1, None)}
    assert state.latest_by(df, ["driver_id"], "event_id").count() == 5


# ---- ordered series --------------------------------------------------------

@pytest.fixture(scope="module")
def lopsided(spark):
    """One key with most of the rows, bunched in time, and many small keys; ``None`` is a key as well."""
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        key = "hot" if rng.random() < 0.6 else rng.choice([None, "warm", f"k{rng.randrange(300)}"])
        at = i if rng.random() < 0.5 else 100000 + i
        rows.append((key, at, i, rng.randrange(5), float(rng.randrange(100))))
    df = spark.createDataFrame(rows, "key string, at bigint, id bigint, v bigint, x double").repartition(5)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("at") % 40).cast("int"))
    return df.withColumns({"text": F.when(F.col("v") > 0, F.concat(F.lit("t"), F.col("at") % 90)), "day": day}).cache()


@pytest.fixture
def many_parts(spark):
    """Small inputs are dealt into many parts as well."""
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {k: spark.conf.get(k, "true") for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


ORDERS = [["at", "id"], ["text", "id"], ["day", "id"], ["id"]]


@pytest.mark.parametrize("order", ORDERS)
def test_rows_are_numbered_like_a_window(lopsided, order, many_parts):
    plain = lopsided.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(*order)).cast("bigint"))
    split = ordered.number_rows(lopsided, ["key"], order, "n")
    assert rows_of(split.select("id", "n")) == rows_of(plain.select("id", "n"))


@pytest.mark.parametrize("order,back", [(ORDERS[0], 1), (ORDERS[1], 9), (ORDERS[2], 3), (ORDERS[3], 700)])
def test_look_back_equals_a_window(lopsided, order, back, many_parts):
    build = lambda w: {"before": F.lag("v", back).over(w), "sum": F.sum("x").over(w.rowsBetween(-back, 0))}
    plain = lopsided.withColumns(build(Window.partitionBy("key").orderBy(*order)))
    split = ordered.look_back(lopsided, ["key"], order, back, build)
    key = lambda df: sorted((r.id, repr(r.before), r["sum"]) for r in df.collect())
    assert key(split) == key(plain)
    whole = lopsided.withColumns(build(Window.partitionBy(F.lit(0)).orderBy("id")))
    assert key(ordered.look_back(lopsided, [], "id", back, build)) == key(whole)


@pytest.mark.parametrize("how", ["sum", "max"])
def test_running_equals_a_window(lopsided, how, many_parts):
    w = Window.partitionBy("key").orderBy("text", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = lopsided.withColumn("r", {"sum": F.sum, "max": F.max}[how]("v").over(w))
    assert rows_of(ordered.running(lopsided, ["key"], ["text", "id"], "v", how, "r").select("id", "r")) == rows_of(plain.select("id", "r"))


def test_tied_rows_of_one_key_are_spread(spark, many_parts):
    df = spark.range(0, 4000, 1, 8).select(F.lit(None).cast("string").alias("key"), F.lit(5).alias("at"), "id")
    got = ordered.number_rows(df, ["key"], "at", "n")
    assert sorted(r.n for r in got.collect()) == list(range(1, 4001))
    assert ordered.running(df.withColumn("one", F.lit(1)), ["key"], "at", "one", "sum", "r").agg(F.max("r"), F.count_distinct("r")).first() == (4000, 4000)
    sizes = [r["count"] for r in ordered.deal(df.repartition(8), ["key"], "at").groupBy(ordered.PART).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 4000
    assert ordered.number_rows(df.limit(0), ["key"], "at", "n").count() == 0


def test_riders_see_the_table_of_their_time(spark, many_parts):
    rng = random.Random(4)
    rows, last, want = [], {}, []
    for i in range(3000):
        cell = 1 if rng.random() < 0.5 else rng.choice([None, rng.randrange(50)])
        if rng.random() < 0.3:
            last[cell] = (f"d{i}", rng.choice(["AVAILABLE", "OFFLINE"]))
            rows.append((cell, "driver", i, *last[cell], None))
        else:
            rows.append((cell, "rider", i, None, None, f"r{i}"))
            if last.get(cell, ("", ""))[1] == "AVAILABLE":
                want.append((f"r{i}", last[cell][0], cell, i))
    df = spark.createDataFrame(rows, "cell bigint, kind string, arrival bigint, driver_id string, status string, rider_id string")
    assert rows_of(matching.match_as_of(df)) == sorted(want, key=repr)


def test_dedup_remembers_only_the_last(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 3, 2), ("a", 4, 1), ("b", 5, 1)], "driver_id string, event_id bigint, ts_ms bigint")
    assert [r.event_id for r in boundary.dedup_last(df).orderBy("event_id").collect()] == [1, 3, 4, 5]
    assert boundary.dedup_last(df, mode="all_seen").count() == 3


def test_multicast_copies_are_dropped_again(spark):
    pings = spark.range(3000).select(
        F.col("id").alias("event_id"), F.concat(F.lit("d"), (F.col("id") % 7).cast("string")).alias("driver_id"),
        (F.lit(40.5) + (F.col("id") * 7919 % 1009) / 2500.0).alias("lat"), (F.lit(-74.2) + (F.col("id") * 6101 % 1013) / 2500.0).alias("lon"), F.col("id").alias("ts_ms"))
    copies = boundary.multicast(pings)
    kept = boundary.dedup_last(copies, ["event_id", "copy_no"])
    assert kept.count() == 3000 and kept.filter("NOT is_primary").count() == 0
    stats = boundary.boundary_stats(pings).first()
    assert stats.multicast_copies == copies.count() - 3000 == stats.dedup_drops > 0
    assert stats.amplification == stats.multicast_copies / 3000
    assert copies.filter(~F.col("partition_key").rlike("^[0-9]+\\|[0-7]$")).count() == 0


def test_sustained_breach(spark):
    counts = [100, 10, 10, 10, 100, 10, 0, 10, 10, 10]
    samples = spark.createDataFrame(list(enumerate(counts)), "sample bigint, records bigint")
    got = series.sustained_breach(samples, 10.0).orderBy("sample").collect()
    assert [r.judged for r in got] == [False, True, True, True, True, True, True, False, True, True]
    assert [r.streak for r in got] == [0, 1, 2, 3, 0, 1, 2, 2, 3, 4]
    assert [r.sample for r in got if r.breach] == [3, 8, 9]


def test_breach_carries_over_midnight(spark):
    rng = random.Random(2)
    counts = [rng.choice([0, 5, 9, 10]) for _ in range(400)]
    samples = spark.createDataFrame([(8640 * 3 - 200 + i, c) for i, c in enumerate(counts)], "sample bigint, records bigint")
    streak, want = 0, []
    for i, c in enumerate(counts):
        if i and counts[i - 1] > 0:
            streak = streak + 1 if c / 10 / 1.0 < 0.92 else 0
        want.append(streak)
    assert [r.streak for r in series.sustained_breach(samples, 1.0).orderBy("sample").collect()] == want


def test_empty_samples_are_counted(spark):
    df = spark.createDataFrame([(0,), (9_999,), (86_450_000,)], "ts_ms bigint")
    got = {r.sample: r.records for r in series.sample_counts(df).collect()}
    assert len(got) == 8646 and got[0] == 2 and got[8645] == 1 and sum(got.values()) == 3


def test_rates(spark):
    df = spark.createDataFrame([("s", 1, 0, 100), ("s", 2, 400, 200), ("s", 3, 2400, 300), ("s", 4, 3400, 290)], "k string, i bigint, ts_ms bigint, value bigint")
    assert [r.rate for r in series.counter_rate(df, ["k"], "i").orderBy("i").collect()] == [0.0, 0.0, 50.0, -10.0]
    assert [r.rate for r in series.counter_rate(df, ["k"], "i", fixed_seconds=5).orderBy("i").collect()] == [20, 20, 20, -2]


def test_transitions_fill_the_gap_with_touching_cells(spark):
    df = spark.createDataFrame([("a", 1, 0, 40.5, -74.2), ("a", 2, 1000, 40.5, -74.2), ("a", 3, 2000, 40.9, -73.8)], "driver_id string, event_id bigint, ts_ms bigint, lat double, lon double")
    out = series.cell_transitions(df.withColumn("cell", cell_of("lat", "lon", 7)), 7).orderBy("timestamp").collect()
    assert [r.interpolated for r in out][0] is False and [r.interpolated for r in out][-1] is False
    assert all(r.interpolated for r in out[1:-1]) and len(out) > 10
    path = spark.createDataFrame([(i, r.current_cell) for i, r in enumerate(out)], "i int, cell bigint")
    step = path.withColumn("prev", F.lag("cell").over(Window.partitionBy(F.lit(0)).orderBy("i"))).filter("prev IS NOT NULL")
    assert step.filter(~F.array_contains(grid_disk("prev", 1), F.col("cell")) | (F.col("prev") == F.col("cell"))).count() == 0
    assert all(1000 <= r.timestamp <= 2000 for r in out[1:])


# ---- figures ---------------------------------------------------------------

@pytest.mark.parametrize("round_bits", [5, 16])
@pytest.mark.parametrize("kind", ["i", "j"])
def test_percentiles_are_exact(spark, round_bits, kind):
    rng = random.Random(9)
    values = [rng.choice([5.0, rng.uniform(-1000, 1000), rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300), 0.0, -0.0]) for _ in range(4001)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.p: r.v for r in pctl(df, "v", kind, (0.25, 0.5, 0.99, 1.0), round_bits=round_bits).collect()}
    ranked, n = sorted(values), len(values)
    for p in (0.25, 0.5, 0.99, 1.0):
        at = math.ceil(p * n) - 1 if kind == "j" else math.floor(p * n)
        assert got[p] == ranked[max(0, min(at, n - 1))]


def test_percentiles_of_other_types(spark):
    df = spark.range(1001).selectExpr("CAST(id AS int) - 500 AS i", "CAST(id AS decimal(30, 18)) / 3 AS d", "date_add(DATE'2024-01-01', CAST(id AS int)) AS t")
    for name in ("i", "d", "t"):
        ranked = sorted(r[0] for r in df.select(name).collect())
        got = {r.p: r[name] for r in pctl(df, name, "i", (0.1, 0.5, 1.0)).collect()}
        assert got == {0.1: ranked[100], 0.5: ranked[500], 1.0: ranked[1000]}


def test_percentile_of_nothing(spark):
    assert pctl(spark.createDataFrame([], "v double"), "v").count() == 0


def test_skew_by_hand(spark):
    counts = spark.createDataFrame([(0, 10), (1, 20), (2, 30)], "partition int, records bigint")
    value = lambda kind, n=None: skew.skew(counts, kind, n).first().skew
    sd = math.sqrt(200 / 3)
    assert value("a") == 2900.0
    assert value("b") == pytest.approx(sd / 20)
    assert value("c") == pytest.approx(sd)
    assert value("d") == 3.0
    assert value("e") == 6.0
    assert value("f", 4) == 2.0
    assert value("h", 4) == 100.0
    assert value("g", 4) == pytest.approx(math.sqrt(sum((c - 15) ** 2 for c in (10, 20, 30, 0)) / 4) / 15 * 100)
    empty = counts.limit(0)
    assert [skew.skew(empty, k).first().skew for k in "abcdefgh"] == [None, 0.0, 0.0, None, 1.0, 1.0, None, 0.0]


def test_match_rate_counts_unmatched_requests(spark):
    riders = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "rider_id string")
    matches = spark.createDataFrame([("a", 10), ("b", 15)], "rider_id string, latency_ms bigint")
    assert tuple(metrics.match_summary(riders, matches).first()) == (4, 2, 25, 12.5, 50.0)


def test_collisions(spark):
    make = lambda vs: spark.createDataFrame([(v,) for v in vs], "s bigint")
    assert metrics.has_collisions(make([5, 8, 13, 8]), "s").first().collides is True
    assert metrics.has_collisions(make([5, 8, 13, 21]), "s").first().collides is False


def test_delivery_without_successes(spark):
    df = spark.createDataFrame([(False, 5), (None, 6)], "ok boolean, latency_ms bigint")
    assert tuple(metrics.delivery_stats(df).first()) == (0, 2, 0.0, 0.0, 100.0)
    assert tuple(metrics.delivery_stats(df.limit(0)).first()) == (0, 0, 0.0, 0.0, 0.0)
