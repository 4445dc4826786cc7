"""Spatial and bit functions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import bits, geo, grid
from ..functions.scalar import dbl, half_up
from ..operators.boundary import boundary_cells
from ..operators.quality import with_cell, with_cell_center
from . import inputs as I, sqltext as Q
from .registry import query

RESOLUTIONS = [3, 4, 5, 6, 7, 9, 10]


def _all_resolutions_sql() -> str:
    src = Q.WORLD
    for res in RESOLUTIONS:
        src = Q.with_cell(src, res, f"cell{res}")
    return f"SELECT event_id, {', '.join(f'cell{r}' for r in RESOLUTIONS)} FROM {src}"


@query("cell_of_point", _all_resolutions_sql())
def cell_of_point(spark, d):
    return I.world_pings(spark, d).select("event_id", *[grid.cell_of("lat", "lon", r).alias(f"cell{r}") for r in RESOLUTIONS])


@query("cell_hex_text", f"""SELECT event_id, cell, lower(hex(cell)) AS hexed, cell AS again, NULL::BIGINT AS rejected FROM {Q.H3_IDS}""")
def cell_hex_text(spark, d):
    hexed = I.h3_ids(spark, d).withColumn("hexed", bits.cell_to_hex("cell"))
    return hexed.select("event_id", "cell", "hexed", bits.hex_to_cell("hexed").alias("again"),
                        bits.hex_to_cell(F.concat(F.lit("x"), F.col("hexed"))).alias("rejected"))


@query("cell_resolution", f"SELECT event_id, CAST(event_id % 16 AS INTEGER) AS resolution FROM {Q.H3_IDS}")
def cell_resolution(spark, d):
    return I.h3_ids(spark, d).select("event_id", bits.cell_resolution("cell").alias("resolution"))


# digit i of an id (1 = coarsest) in the comparison SQL
_DIGIT = "((cell >> (45 - 3 * i)) & 7)"
_PENTAGONS = "(4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)"
_VALID = f"""(SELECT s.*, ((cell >> 59) & 31) = 1 AND ((cell >> 56) & 7) = 0 AND ((cell >> 45) & 127) < 122
   AND len(list_filter(range(1, 16), lambda i: CASE WHEN i <= ((cell >> 52) & 15) THEN {_DIGIT} = 7 ELSE {_DIGIT} <> 7 END)) = 0
   AND NOT (((cell >> 45) & 127) IN {_PENTAGONS}
     AND coalesce(list_filter(list_transform(range(1, 16), lambda i: {_DIGIT}), lambda g: g <> 0)[1], 0) = 1) AS is_valid
   FROM {Q.H3_IDS} s)"""


@query("cell_validity", f"SELECT event_id, cell, is_valid FROM {_VALID}")
def cell_validity(spark, d):
    return I.h3_ids(spark, d).select("event_id", "cell", bits.h3_is_valid("cell").alias("is_valid"))


def _h3_parent_sql(res: int) -> str:
    keep = ~(15 << 52) & ((1 << 63) - 1)
    return f"CASE WHEN ((cell >> 52) & 15) >= {res} THEN (cell & {keep}) | {(res << 52) | ((1 << (45 - 3 * res)) - 1)} END"


@query("cell_parent_h3", f"SELECT event_id, cell, {_h3_parent_sql(3)} AS parent3, {_h3_parent_sql(5)} AS parent5, {_h3_parent_sql(7)} AS parent7 FROM {Q.H3_IDS}")
def cell_parent_h3(spark, d):
    return I.h3_ids(spark, d).select("event_id", "cell", *[bits.h3_parent("cell", r).alias(f"parent{r}") for r in (3, 5, 7)])


@query("cell_parent_grid", f"SELECT event_id, cell, parent, grandparent FROM "
       f"{Q.with_parent(Q.with_parent(Q.with_cell(Q.WORLD, 9), 9, 5), 9, 3, 'grandparent')}")
def cell_parent_grid(spark, d):
    return with_cell(I.world_pings(spark, d), 9).select(
        "event_id", "cell", grid.cell_parent("cell", 5, 9).alias("parent"), grid.cell_parent("cell", 3, 9).alias("grandparent"))


# every id two levels finer is an ancestor's id plus two digits; invalid ones fall out
_CHILDREN = f"""SELECT event_id, child FROM (SELECT event_id, cell, own, (kept | (r::BIGINT << 52) | (({1 << 45} - 1) >> (3 * r))
     | (a << (42 - 3 * own)) | (b << (39 - 3 * own))) AS child, a, b, base, lead FROM (
   SELECT event_id, cell, (cell >> 52) & 15 AS own, own + 2 AS r, (cell >> 45) & 127 AS base,
     (cell & {~(15 << 52) & ((1 << 63) - 1)}) & ~((1::BIGINT << (45 - 3 * own)) - 1) AS kept,
     coalesce(list_filter(list_transform(range(1, CAST(own AS INTEGER) + 1), lambda i: {_DIGIT}), lambda g: g <> 0)[1], 0) AS lead
   FROM {_VALID} WHERE is_valid AND ((cell >> 52) & 15) <= 13),
   (SELECT CAST(unnest(range(7)) AS BIGINT) AS a), (SELECT CAST(unnest(range(7)) AS BIGINT) AS b))
 WHERE NOT (base IN {_PENTAGONS} AND lead = 0 AND (CASE WHEN a <> 0 THEN a ELSE b END) = 1)"""


@query("cell_children_h3", _CHILDREN)
def cell_children_h3(spark, d):
    valid = I.h3_ids(spark, d).filter(bits.h3_is_valid("cell")).select("event_id", "cell")
    return bits.h3_children(valid, levels=2).select("event_id", "child")


_GRID_CHILD_PARENTS = Q.with_parent(
    f"(SELECT DISTINCT parent AS cell, p.x + o.d AS child FROM (SELECT DISTINCT parent, start_ AS x FROM "
    f"{Q.with_parent('(SELECT DISTINCT cell AS parent, cell FROM ' + Q.with_cell(Q.PINGS, 6) + ')', 6, 8, 'start_')}) p, {Q.disk(6)} o)",
    8, 6, "up_", "child")


@query("cell_children_grid", f"SELECT cell, child FROM {_GRID_CHILD_PARENTS} WHERE up_ = cell")
def cell_children_grid(spark, d):
    cells = with_cell(I.pings(spark, d), 6).select("cell").distinct()
    return grid.grid_children(cells, 8, 6).select("cell", "child")


@query("disk_cells", f"SELECT event_id, cell + d AS near FROM {Q.with_cell(Q.PINGS, 9)}, {Q.disk(2)}")
def disk_cells(spark, d):
    return with_cell(I.pings(spark, d), 9).select("event_id", F.explode(grid.grid_disk("cell", 2)).alias("near"))


_TURNED = f"""(SELECT p.event_id, p.cell + o.d + w.turns * {Q.turn(9)} AS near FROM {Q.with_cell(Q.at_seam(Q.PINGS), 9)} p, {Q.disk(2)} o,
  (SELECT unnest([-1, 0, 1]) AS turns) w)"""


@query("disk_cells_across_seam", f"SELECT event_id, near FROM {_TURNED} WHERE abs({Q.center_xy('near', 9)[0]}) <= {Q.num(math.pi * Q.RADIUS + math.sqrt(3.0) * Q.edge(9) / 2.0)}")
def disk_cells_across_seam(spark, d):
    """The disks of pings around the antimeridian; those that touch it go on beyond it."""
    pings = with_cell(I.at_seam(I.pings(spark, d)), 9)
    return pings.select("event_id", F.explode(grid.disk_across_seam("cell", 9, 2)).alias("near"))


_CLAT, _CLON = Q.center("cell", 9)


@query("cell_center", f"SELECT event_id, {Q.half_up(_CLAT, 8)} AS center_lat, {Q.half_up(_CLON, 8)} AS center_lon FROM {Q.with_cell(Q.WORLD, 9)}")
def cell_center(spark, d):
    out = with_cell_center(with_cell(I.world_pings(spark, d), 9), 9)
    return out.select("event_id", half_up("center_lat", 8).alias("center_lat"), half_up("center_lon", 8).alias("center_lon"))


def zone_polygons(spark, d):
    """One triangle per customer, placed by the customer's key."""
    c = F.col("c_custkey")
    lat = dbl(40.5) + dbl(0.4) * ((c * 7919) % 1009).cast("double") / dbl(1009)
    lon = dbl(-74.2) + dbl(0.5) * ((c * 6101) % 1013).cast("double") / dbl(1013)

    def point(north: float, east: float):
        return F.struct((lat + dbl(north)).alias("lat"), (lon + dbl(east)).alias("lon"))

    return I.table(spark, d, "customer").select(
        c.alias("zone"), F.array(point(0.0, 0.0), point(0.031, 0.005), point(0.007, 0.043)).alias("ring"))


def _zone_cells_sql(res: int) -> str:
    e = Q.edge(res)
    lat, lon = Q.center("cell", res)
    width, height = Q.num(3.0**0.5 * e), Q.num(1.5 * e)
    y = lambda v: f"({Q.num(Q.RADIUS)} * sin(radians({v})))"
    x = lambda v: f"({Q.num(Q.RADIUS)} * radians({v}))"
    cross = lambda i, j: (f"(((a{i} > la) <> (a{j} > la)) AND lo < (o{j} - o{i}) * (la - a{i}) / (a{j} - a{i}) + o{i})::INTEGER")
    return f"""(SELECT zone, cell FROM (SELECT *, {lat} AS la, {lon} AS lo FROM (
  SELECT *, ({res}::BIGINT << 52) | ((q + 33554432) << 26) | (r + 33554432) AS cell FROM (
   SELECT *, unnest(range(CAST(floor({x('o0')} / {width} - r / 2.0e0) AS BIGINT), CAST(ceil({x('o2')} / {width} - r / 2.0e0) AS BIGINT) + 1)) AS q FROM (
    SELECT *, unnest(range(CAST(floor({y('a0')} / {height}) AS BIGINT), CAST(ceil({y('a1')} / {height}) AS BIGINT) + 1)) AS r FROM (
     SELECT c_custkey AS zone, {Q.num(40.5)} + {Q.num(0.4)} * CAST((c_custkey * 7919) % 1009 AS DOUBLE) / 1009.0e0 AS a0,
      {Q.num(-74.2)} + {Q.num(0.5)} * CAST((c_custkey * 6101) % 1013 AS DOUBLE) / 1013.0e0 AS o0,
      a0 + {Q.num(0.031)} AS a1, o0 + {Q.num(0.005)} AS o1, a0 + {Q.num(0.007)} AS a2, o0 + {Q.num(0.043)} AS o2 FROM customer)))))
 WHERE ({cross(0, 1)} + {cross(1, 2)} + {cross(2, 0)}) % 2 = 1)"""


@query("polygon_cells", f"SELECT zone, cell FROM {_zone_cells_sql(9)}")
def polygon_cells(spark, d):
    return grid.polygon_cells(zone_polygons(spark, d), 9).select("zone", "cell")


def _geohash_sql(p: int) -> str:
    bits_ = 5 * p
    n_lon, n_lat = (bits_ + 1) // 2, bits_ // 2
    qlon = f"least(CAST(floor((lon + 180.0e0) / 360.0e0 * {Q.num(2.0**n_lon)}) AS BIGINT), {2**n_lon - 1})"
    qlat = f"least(CAST(floor((lat + 90.0e0) / 180.0e0 * {Q.num(2.0**n_lat)}) AS BIGINT), {2**n_lat - 1})"
    # bit j of the code, counted from the first: even ones are longitude
    one = lambda j: (f"((({qlon}) >> {n_lon - 1 - j // 2}) & 1)" if j % 2 == 0 else f"((({qlat}) >> {n_lat - 1 - j // 2}) & 1)")
    letters = []
    for i in range(p):
        value = " + ".join(f"{one(5 * i + b)} * {2 ** (4 - b)}" for b in range(5))
        letters.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST({value} AS INTEGER) + 1, 1)")
    return "concat(" + ", ".join(letters) + ")"


@query("geohash_text", f"SELECT event_id, {_geohash_sql(6)} AS geohash6, {_geohash_sql(7)} AS geohash7 FROM {Q.WORLD}")
def geohash_text(spark, d):
    return I.world_pings(spark, d).select("event_id", geo.geohash("lat", "lon", 6).alias("geohash6"),
                                          geo.geohash("lat", "lon", 7).alias("geohash7"))


@query("haversine_distance", f"""SELECT event_id, {Q.half_up(Q.haversine('lat', 'lon', Q.num(40.7128), Q.num(-74.006)), 6)} AS km,
  {Q.half_up(Q.haversine('lat', 'lon', Q.num(19.076), Q.num(72.8777)), 6)} AS far_km FROM {Q.WORLD}""")
def haversine_distance(spark, d):
    return I.world_pings(spark, d).select(
        "event_id", half_up(geo.haversine_km("lat", "lon", dbl(40.7128), dbl(-74.006)), 6).alias("km"),
        half_up(geo.haversine_km("lat", "lon", dbl(19.076), dbl(72.8777)), 6).alias("far_km"))


def _flat_sql(factor: float) -> str:
    a, b = f"(({Q.num(40.7128)} - lat) * 111.0e0)", f"(({Q.num(-74.006)} - lon) * 85.0e0)"
    return Q.half_up(f"sqrt({a} * {a} + {b} * {b}) * {Q.num(factor)}", 2)


@query("flat_distance", f"SELECT event_id, {_flat_sql(1.0)} AS km, {_flat_sql(0.5)} AS half_km FROM {Q.PINGS}")
def flat_distance(spark, d):
    return I.pings(spark, d).select("event_id", geo.flat_km("lat", "lon", dbl(40.7128), dbl(-74.006)).alias("km"),
                                    geo.flat_km("lat", "lon", dbl(40.7128), dbl(-74.006), 0.5).alias("half_km"))


def _ahead_sql() -> str:
    lat, lon = Q.center("cell", 9)
    src = f"""(SELECT event_id, heading, speed, {lat} AS la, {lon} AS lo FROM (SELECT *, CAST(event_id % 360 AS DOUBLE) + 0.25e0 AS heading,
      CAST(user_id % 333 AS DOUBLE) / 10.0e0 AS speed FROM {Q.with_cell(Q.PINGS, 9)}))"""
    moved = f"""(SELECT event_id, speed * 60.0e0 / 6371000.0e0 AS ang, radians(heading) AS th, radians(la) AS ph, radians(lo) AS lm,
      asin(sin(ph) * cos(ang) + cos(ph) * sin(ang) * cos(th)) AS ph2,
      lm + atan2(sin(th) * sin(ang) * cos(ph), cos(ang) - sin(ph) * sin(ph2)) AS lm2,
      degrees(ph2) AS lat, degrees(lm2) AS lon FROM {src})"""
    return (f"SELECT event_id, {Q.half_up('lat', 8)} AS ahead_lat, {Q.half_up('lon', 8)} AS ahead_lon, cell AS ahead_cell "
            f"FROM {Q.with_cell(moved, 9)}")


@query("dead_reckoning", _ahead_sql())
def dead_reckoning(spark, d):
    moving = with_cell(I.pings(spark, d), 9).withColumns({
        "heading": (F.col("event_id") % 360).cast("double") + dbl(0.25),
        "speed_mps": (F.col("user_id") % 333).cast("double") / dbl(10.0)})
    out = geo.project_ahead(moving, 60.0)
    return out.select("event_id", half_up("ahead_lat", 8).alias("ahead_lat"), half_up("ahead_lon", 8).alias("ahead_lon"), "ahead_cell")


@query("latitude_band", f"SELECT event_id, CAST(floor((lat + 90.0e0) / 10.0e0) AS INTEGER) AS band FROM {Q.WORLD}")
def latitude_band(spark, d):
    return I.world_pings(spark, d).select("event_id", geo.lat_band("lat").alias("band"))


@query("clamp_to_box", f"SELECT event_id, greatest({Q.num(40.4774)}, least({Q.num(40.9176)}, lat)) AS lat, "
       f"greatest({Q.num(-74.2591)}, least({Q.num(-73.7004)}, lon)) AS lon FROM {Q.WORLD}")
def clamp_to_box(spark, d):
    return I.world_pings(spark, d).select("event_id", geo.clamp("lat", 40.4774, 40.9176).alias("lat"),
                                          geo.clamp("lon", -74.2591, -73.7004).alias("lon"))


TOUCHED_SQL = Q.with_parent(f"(SELECT p.*, p.cell + o.d AS near FROM {Q.with_cell(Q.PINGS, 9)} p, {Q.disk(3)} o)", 9, 5, "coarse", "near")


@query("boundary_cells", f"SELECT DISTINCT event_id, coarse FROM {TOUCHED_SQL}")
def boundary_cells_query(spark, d):
    return boundary_cells(I.pings(spark, d)).select("event_id", F.explode("coarse_cells").alias("coarse"))
