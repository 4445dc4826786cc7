"""Bit layout, grid, hashes and binary numbers against literal vectors and plain Python."""

import math
import random
import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetgrid.functions import binary, bits, geo, grid, hashing
from fleetgrid.functions.scalar import dbl, half_up, padded_id, round2

VECTORS = [("892a1072b43ffff", 9), ("872a1072bffffff", 7), ("832830fffffffff", 3), ("85283473fffffff", 5), ("89283082837ffff", 9)]


@pytest.mark.parametrize("text,resolution", VECTORS)
def test_published_ids(value_of, text, resolution):
    cell = bits.hex_to_cell(F.lit(text))
    assert value_of(bits.cell_resolution(cell)) == resolution
    assert value_of(bits.h3_is_valid(cell)) is True
    assert value_of(bits.cell_to_hex(cell)) == text


def test_a_used_digit_may_not_be_seven(value_of):
    """Digit 7 of this often quoted id is 7, which only unused digits may be."""
    cell = bits.hex_to_cell(F.lit("872a1072fffffff"))
    assert value_of(bits.cell_resolution(cell)) == 7
    assert value_of(bits.h3_is_valid(cell)) is False


def test_decimal_ids(value_of):
    assert value_of(bits.cell_resolution(F.lit(615732233132539903))) == 8
    assert value_of(bits.h3_is_valid(F.lit(6157323354570604543))) is False
    assert value_of(bits.h3_is_valid(F.lit(None).cast("bigint"))) is False


def test_parent_and_bad_hex(value_of):
    assert value_of(bits.cell_to_hex(bits.h3_parent(bits.hex_to_cell(F.lit("89283082837ffff")), 3))) == "832830fffffffff"
    assert value_of(bits.h3_parent(bits.hex_to_cell(F.lit("832830fffffffff")), 5)) is None
    assert value_of(bits.hex_to_cell(F.lit("not hex"))) is None
    assert value_of(bits.hex_to_cell(F.lit("ffffffffffffffff"))) == -1


def test_children(spark):
    hexagon = spark.createDataFrame([(int("832830fffffffff", 16),)], "cell bigint")
    children = bits.h3_children(hexagon, 5)
    assert children.count() == 49 == children.select("child").distinct().count()
    assert children.filter(bits.h3_parent("child", 3) != F.col("cell")).count() == 0
    pentagon = (1 << 59) | (4 << 45) | ((1 << 45) - 1)  # resolution 0, base cell 4
    five = spark.createDataFrame([(pentagon,)], "cell bigint")
    assert bits.h3_children(five, 1).count() == 6
    assert bits.h3_children(five, 2).count() == 41


def test_children_of_one_partition_are_made_by_many_tasks(spark):
    """Rows are dealt out before they multiply, and what is no valid cell has no children, at a pentagon or not."""
    hexagon, five, seven = (int(t, 16) for t in ("872a1072bffffff", "8009fffffffffff", "872a1071fffffff"))
    cells = spark.createDataFrame([(hexagon,)] * 8 + [(five,), (five + (1 << 56),), (seven,), (0,), (None,)], "cell bigint").coalesce(1)
    for levels in (1, 2, 3):
        opened = bits.h3_children(cells, levels=levels)
        assert opened.rdd.getNumPartitions() > 1
        counts = {r.cell: r["count"] for r in opened.filter(bits.h3_is_valid("child")).groupBy("cell").count().collect()}
        assert counts == {hexagon: 8 * 7**levels, five: 1 + 5 * (7**levels - 1) // 6}
        assert opened.count() == sum(counts.values())


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(3)
    rows = [(i, rng.uniform(-75, 75), rng.uniform(-179, 179)) for i in range(4000)]
    return spark.createDataFrame(rows, "i int, lat double, lon double").cache()


@pytest.mark.parametrize("resolution", [3, 5, 7, 9, 10])
def test_centre_lies_in_its_cell(points, resolution):
    cells = points.withColumn("cell", grid.cell_of("lat", "lon", resolution))
    lat, lon = grid.cell_center("cell", resolution)
    assert cells.withColumns({"a": lat, "b": lon}).filter(grid.cell_of("a", "b", resolution) != F.col("cell")).count() == 0
    assert cells.filter(bits.cell_resolution("cell") != resolution).count() == 0


@pytest.mark.parametrize("k,size", [(0, 1), (1, 7), (2, 19), (3, 37)])
def test_disks(points, k, size):
    disks = points.limit(50).withColumn("cell", grid.cell_of("lat", "lon", 9)).withColumn("disk", grid.grid_disk("cell", k))
    assert disks.filter(F.size(F.array_distinct("disk")) != size).count() == 0
    back = disks.withColumn("n", F.explode("disk")).filter(~F.array_contains(grid.grid_disk("n", k), F.col("cell")))
    assert back.count() == 0


@pytest.mark.parametrize("resolution,k", [(1, 2), (4, 2), (7, 3), (9, 2)])
def test_disks_across_the_antimeridian(spark, resolution, k):
    rng = random.Random(5)
    wide = 3.0 if resolution < 5 else 0.03
    rows = [(i, rng.uniform(-1, 1), 180.0 + rng.uniform(-wide, wide)) for i in range(200)] + [(-1, 0.0, 180.0), (-2, 0.0, -180.0), (-3, 0.0, 12.0)]
    cells = spark.createDataFrame(rows, "i int, lat double, lon double").withColumn("lon", grid.wrapped_longitude("lon"))
    assert cells.filter("lon < -180 OR lon >= 180").isEmpty() and cells.filter("i < -1 AND i > -3 AND lon <> -180").isEmpty()
    cells = cells.withColumn("cell", grid.cell_of("lat", "lon", resolution)).withColumn("disk", grid.disk_across_seam("cell", resolution, k))
    # distinct, at least the part of the plain disk that lies on the globe, and mutual
    assert cells.filter((F.size("disk") != F.size(F.array_distinct("disk"))) | ~F.array_contains("disk", F.col("cell"))).isEmpty()
    each = cells.withColumn("n", F.explode("disk"))
    assert each.filter(~F.array_contains(grid.disk_across_seam("n", resolution, k), F.col("cell"))).isEmpty()
    # every id of a disk can be the cell of a point: its centre is at most half a cell beyond the antimeridian
    beyond = 90.0 * math.sqrt(3.0) * grid.edge_km(resolution) / (math.pi * grid.EARTH_KM)
    assert each.filter(F.abs(grid.cell_center("n", resolution)[1]) > 180.0 + beyond * (1 + 1e-9)).isEmpty()
    # a step east and west of a point on the antimeridian is in its disk
    step = 180.0 * math.sqrt(3.0) * grid.edge_km(resolution) / (math.pi * grid.EARTH_KM)
    for way in (-step, step):
        beside = cells.filter("i < 0").withColumn("other", grid.cell_of("lat", grid.wrapped_longitude(F.col("lon") + way), resolution))
        assert beside.filter(~F.array_contains("disk", F.col("other"))).isEmpty()
    assert cells.filter("i = -3").filter(F.col("disk") == grid.grid_disk("cell", k)).count() == (1 if resolution > 1 else cells.filter("i = -3").count())


def test_children_many_levels_down(spark):
    hexagon = spark.createDataFrame([(0x832830FFFFFFFFF,)], "cell long")
    children = bits.h3_children(hexagon, levels=7)
    assert children.agg(F.count("*"), F.countDistinct("child"), F.min(bits.cell_resolution("child"))).first() == (7**7, 7**7, 10)
    assert children.filter(bits.h3_parent("child", 3) != F.col("cell")).isEmpty()


def test_grid_children_many_levels_down(spark):
    one = spark.range(1).select(grid.cell_of(dbl(12.97), dbl(77.59), 4).alias("cell"))
    children = grid.grid_children(one, 11, 4)
    found, distinct = children.agg(F.count("*"), F.countDistinct("child")).first()
    assert found == distinct and abs(found / 7**7 - 1) < 0.01


def test_polygon_against_every_edge(spark):
    rng = random.Random(5)
    turns = [2 * math.pi * i / 10_000 for i in range(10_000)]
    star = [(19 + 0.2 * (1 + 0.5 * rng.random()) * math.sin(t), 72.9 + 0.2 * (1 + 0.5 * rng.random()) * math.cos(t)) for t in turns]
    bow = [(10.0, 20.0), (10.3, 20.4), (10.3, 20.0), (10.0, 20.4)]
    rings = [("star", star), ("bow", bow), ("bow", bow), ("flat", [(1.0, 1.0), (1.0, 2.0)]), ("none", []), ("null", None)]
    df = spark.createDataFrame(rings, "name string, ring array<struct<lat:double,lon:double>>")
    got = Counter(tuple(r) for r in grid.polygon_cells(df, 7).select("name", "cell").collect())
    # every cell of the box against every edge
    want = Counter()
    for name, ring in rings[:3]:
        box = spark.range(400).crossJoin(spark.range(400).withColumnRenamed("id", "j")).select(grid.cell_of(
            dbl(min(p[0] for p in ring)) + F.col("id") * dbl((max(p[0] for p in ring) - min(p[0] for p in ring)) / 399),
            dbl(min(p[1] for p in ring)) + F.col("j") * dbl((max(p[1] for p in ring) - min(p[1] for p in ring)) / 399), 7).alias("cell")).distinct()
        lat, lon = grid.cell_center("cell", 7)
        for cell, y, x in box.select("cell", lat, lon).collect():
            crossed = sum(1 for (a, b), (c, e) in zip(ring, ring[1:] + ring[:1], strict=True) if (a > y) != (c > y) and x < (e - b) * (y - a) / (c - a) + b)
            want[name, cell] += crossed % 2
    assert got == +want and len(got) > 300


def test_grid_children_cover_each_fine_cell_once(spark):
    area = spark.range(0, 400).select((F.lit(40.6) + (F.col("id") % 20) * 0.01).alias("lat"), (F.lit(-74.1) + F.floor(F.col("id") / 20) * 0.01).alias("lon"))
    coarse = area.select(grid.cell_of("lat", "lon", 6).alias("cell")).distinct()
    children = grid.grid_children(coarse, 8, 6)
    assert children.count() == children.select("child").distinct().count()
    assert 45 * coarse.count() <= children.count() <= 53 * coarse.count()


@pytest.mark.parametrize("fine,k,coarse", [(9, 3, 5), (9, 2, 7), (8, 3, 5), (9, 1, 8), (7, 3, 3)])
def test_border_shortcuts_equal_the_full_disk(points, fine, k, coarse):
    cells = points.withColumn("cell", grid.cell_of("lat", "lon", fine)).select("cell")
    # add the neighbourhood of coarse rims, where centres fall exactly on edges
    cells = cells.union(cells.limit(300).select(F.explode(grid.grid_disk("cell", 6)).alias("cell")))
    quick = grid.boundary_cells_of("cell", fine, k, coarse)
    full = F.array_sort(F.array_distinct(F.transform(grid.grid_disk("cell", k), lambda c: grid.cell_parent(c, coarse, fine))))
    assert cells.filter(quick != full).count() == 0


def test_geohash_and_bands(value_of):
    assert value_of(geo.geohash(dbl(57.64911), dbl(10.40744), 11)) == "u4pruydqqvj"
    assert value_of(geo.geohash(dbl(42.605), dbl(-5.603), 5)) == "ezs42"
    assert value_of(geo.lat_band(dbl(90.0))) == 18
    assert value_of(geo.lat_band(dbl(-90.0))) == 0


def test_distances(value_of):
    assert value_of(geo.haversine_km(dbl(0), dbl(0), dbl(0), dbl(180))) == pytest.approx(math.pi * 6371)
    assert value_of(geo.flat_km(dbl(40.0), dbl(-74.0), dbl(40.1), dbl(-74.0))) == 11.1
    assert value_of(geo.clamp(dbl(5), 0, 1)) == 1.0
    lat, lon = geo.destination(dbl(0), dbl(0), dbl(90), dbl(math.pi * 6371000 / 2))
    assert value_of(lat) == pytest.approx(0, abs=1e-9) and value_of(lon) == pytest.approx(90)


def py_string_hash(text):
    h = 0
    data = text.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i:i + 2], "big")) & 0xFFFFFFFF
    return h


def py_murmur2(data):
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = 0x9747B28C ^ len(data)
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        k = int.from_bytes(data[i:i + 4], "little") * m & mask
        k = (k ^ k >> 24) * m & mask
        h = (h * m & mask) ^ k
    rest = data[whole:]
    if rest:
        h = (h ^ int.from_bytes(rest, "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


def test_string_hashes(spark):
    texts = ["", "a", "driver-1", "drëiver", "日本", "a😀b", "x" * 300] + [f"D-{i:05d}" for i in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", hashing.java_hash("t").alias("h"), hashing.murmur2(F.encode("t", "UTF-8")).alias("m"),
                      hashing.bytes_hash(F.encode("t", "UTF-8")).alias("b")).collect()
    for r in got:
        assert r.h == py_string_hash(r.t)
        assert r.m == py_murmur2(r.t.encode())
        b = 1
        for byte in r.t.encode():
            b = (b * 31 + (byte - 256 if byte > 127 else byte)) & 0xFFFFFFFF
        assert r.b == b


def test_seeds(spark):
    def expected(entity, scenario):
        mask = (1 << 64) - 1
        start = (py_string_hash(f"{entity}:{scenario}") + 31) & 0xFFFFFFFF
        h = start - (1 << 32) if start >= 1 << 31 else start
        h &= mask
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ h >> 33) * factor & mask
        h ^= h >> 33
        return h - (1 << 64) if h >= 1 << 63 else h

    rows = spark.range(10000).select(F.format_string("D-%05d", "id").alias("e"))
    got = rows.select("e", hashing.seed_of("e", F.lit("s")).alias("seed")).collect()
    assert all(r.seed == expected(r.e, "s") for r in got)
    assert len({r.seed for r in got}) == 10000
    assert expected("D-1", "s") != expected("D-1", "t")


def test_fold_is_signed(value_of):
    cell = int("832830fffffffff", 16)
    folded = value_of(hashing.fold32(F.lit(cell)))
    assert folded == struct.unpack(">i", struct.pack(">I", (cell ^ cell >> 32) & 0xFFFFFFFF))[0]
    assert abs(folded) % 12 == 4 and folded % 12 == 8


NUMBERS = [0.0, 1.0, -1.0, 40.7128, -74.006, 2.0 ** 52, 2.0 ** -1022, 5e-324, 1.7976931348623157e308, math.pi, 1 / 3, -0.1,
           float("inf"), float("-inf"), -0.0, 8.0, 7.999999999999999]


def test_doubles_and_floats_match_ieee(spark):
    rng = random.Random(1)
    numbers = NUMBERS + [rng.uniform(-180, 180) for _ in range(200)] + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(200)]
    rows = spark.createDataFrame([(v,) for v in numbers], "v double")
    got = rows.select("v", binary.put_f64("v").alias("d"), binary.get_f64(binary.put_f64("v"), 1).alias("back")).collect()
    for r in got:
        assert bytes(r.d) == struct.pack(">d", r.v), r.v
        assert struct.pack(">d", r.back) == struct.pack(">d", r.v)
    small = [v for v in numbers if v == 0 or 1e-30 < abs(v) < 1e30]
    rows = spark.createDataFrame([(v,) for v in small], "v double")
    for r in rows.select("v", binary.put_f32("v").alias("d"), binary.get_f32(binary.put_f32("v"), 1).alias("back")).collect():
        assert bytes(r.d) == struct.pack(">f", r.v)
        assert r.back == struct.unpack(">f", struct.pack(">f", r.v))[0]


def test_integers(value_of):
    for v in (0, 1, -1, 2**31 - 1, -(2**31)):
        assert bytes(value_of(binary.put_i32(F.lit(v)))) == struct.pack(">i", v)
        assert value_of(binary.get_i32(binary.put_i32(F.lit(v)), 1)) == v
    for v in (0, -1, 2**63 - 1, -(2**63)):
        assert bytes(value_of(binary.put_i64(F.lit(v).cast("bigint")))) == struct.pack(">q", v)
        assert value_of(binary.get_i64(binary.put_i64(F.lit(v).cast("bigint")), 1)) == v


def test_rounding_and_ids(value_of):
    assert value_of(round2(dbl(2.675))) == math.floor(2.675 * 100 + 0.5) / 100
    assert value_of(half_up(dbl(-1.25), 1)) == -1.2
    assert value_of(padded_id(F.lit(7))) == "driver-00007"
