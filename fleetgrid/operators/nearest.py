"""Nearest driver for every rider, without comparing all pairs in a crowded cell.

A rider may be matched with any driver in the k-disk of cells around it, which
goes on beyond the antimeridian.  A cell is halved in both directions as often as
its count asks for, so that its parts hold a few drivers each however dense it is.
The part that a rider stands in names up to 16 real drivers; the nearest of them is
a distance within reach.  Cells whose bounding box lies farther off are dropped, and of the
others only the parts that the circle of that distance meets are compared, so a
rider costs about the same in a dense table as in a thin one.

Where drivers lie unevenly inside a cell, a part may still be crowded or the circle
meet too many parts.  Such a cell is opened for the rider step by step into 16 parts, summarised by
count, bounding box and one real driver, until every part that is left is small.
From a summary follow a least possible distance (box) and a reachable one
(driver); parts that cannot win are dropped before any driver is looked at.
What riders still have to look at, the frontier of (rider, part) rows, is written
once for each step.  The small parts of a step are compared before the crowded
ones are opened, so their answers close most of those.  Each step keeps the winner,
so the result is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import HAVERSINE_KM, haversine_km
from ..functions.grid import cell_of, disk_across_seam, edge_km, plane_xy
from ..functions.scalar import dbl, shift_left, spread
from ..session import materialise

# Parts with more distinct positions than this are opened further.
LEAF_POSITIONS = 128
# Up to this many positions around a rider are compared without sorting out cells first.
FEW = 16
# 16-fold splits of a cell: 300 m at resolution 9 down to 2 cm.
MAX_DEPTH = 7
# The same in halvings; where a part of a cell has to be named, so many are made that it holds a quarter of a leaf on the average.
MAX_HALVINGS = 2 * MAX_DEPTH
# Halvings of a part whose drivers tell what is within reach, one for each of its 16 places.
POINT_HALVINGS = 2
# With more parts of one cell in the circle around a rider, the cell is opened step by step.
MAX_LOOKUPS = 16
EARTH_PLANE_KM = 6371.0088


def _summary(spots: DataFrame, keys: list[str]) -> DataFrame:
    """Count, box and one real driver per part; every column has fixed width, so it hash-aggregates."""
    return spots.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("d_lat").alias("lat0"), F.max("d_lat").alias("lat1"),
        F.min("d_lon").alias("lon0"), F.max("d_lon").alias("lon1"),
        F.max_by("d_lon", "d_lat").alias("lon_at_lat1"))


def _reachable_km(lat: Column, lon: Column, box: Column) -> Column:
    """Distance to the northernmost driver of the part: an upper bound on the answer."""
    return haversine_km(lat, lon, box["lat1"], box["lon_at_lat1"])


def _least_km(lat: Column, lon: Column, box: Column) -> Column:
    """No driver in the box is closer than this: the larger of the latitude and the meridian gap, the shorter way round."""
    zero, turn = dbl(0.0), dbl(360.0)
    north = F.radians(F.greatest(box["lat0"] - lat, lat - box["lat1"], zero))
    direct = F.greatest(box["lon0"] - lon, lon - box["lon1"], zero)
    east = F.radians(F.greatest(F.least(direct, turn + box["lon0"] - lon, turn + lon - box["lon1"]), zero))
    to_meridian = F.when(east < dbl(1.5), F.asin(F.cos(F.radians(lat)) * F.sin(east))).otherwise(zero)
    # a hair less, so that rounding can never drop the winner
    return F.greatest(north, to_meridian) * dbl(HAVERSINE_KM * (1.0 - 1e-9)) - dbl(1e-9)


def _part(depth: int) -> Column:
    """Number of the part at ``depth`` within its cell, from the finest subdivision."""
    drop = 2 * (MAX_DEPTH - depth)
    return F.shiftleft(F.shiftright("__row", drop), 2 * depth).bitwiseOR(F.shiftright("__column", drop))


def _offset(lat: str, lon: str, resolution: int) -> tuple[Column, Column]:
    """Plane coordinates in km relative to the centre of ``cell``, the shorter way round."""
    x0, y0 = plane_xy("cell", resolution)
    x = dbl(EARTH_PLANE_KM) * F.radians(lon) - x0
    turn = dbl(2.0 * math.pi * EARTH_PLANE_KM)
    return x - turn * F.floor(x / turn + dbl(0.5)), dbl(EARTH_PLANE_KM) * F.sin(F.radians(lat)) - y0


def _step(offset: Column, resolution: int) -> Column:
    """Number of the finest row or column of the cell; what lies outside counts to the outermost."""
    steps = 2**MAX_HALVINGS
    at = F.floor((offset / dbl(2.0 * edge_km(resolution)) + dbl(0.5)) * dbl(float(steps)))
    return F.greatest(F.least(at, F.lit(steps - 1)), F.lit(0)).cast("bigint")


def _spots(drivers: DataFrame, resolution: int) -> DataFrame:
    """Distinct driver positions with the id that wins a tie there, and their place inside the cell."""
    spots = drivers.select("cell", "driver_id", F.col("lat").alias("d_lat"), F.col("lon").alias("d_lon"))
    spots = spots.groupBy("cell", "d_lat", "d_lon").agg(F.min("driver_id").alias("driver_id"))
    x, y = _offset("d_lat", "d_lon", resolution)
    return spots.withColumns({"__column": _step(x, resolution), "__row": _step(y, resolution)})


def _halvings(n: Column, leaf_positions: int) -> Column:
    """How often a cell with ``n`` positions is halved, by comparisons of whole numbers."""
    return sum((F.when(n * 4 > F.lit(leaf_positions * 4**i), 1).otherwise(0) for i in range(MAX_HALVINGS)), F.lit(0)).cast("int")


def _shift_right(value: Column, places: Column) -> Column:
    return F.call_function("shiftright", value, places.cast("int"))


def _place(row: Column, column: Column, halvings: Column) -> Column:
    """Number of a part of a cell that is halved so often, from its row and column."""
    return shift_left(row, halvings).bitwiseOR(column)


def _halved(finest: Column, halvings: Column) -> Column:
    return _shift_right(finest, F.lit(MAX_HALVINGS) - halvings)


def _with_place(rows: DataFrame, out: str = "place") -> DataFrame:
    h = F.col("halvings")
    return rows.withColumn(out, _place(_halved(F.col("__row"), h), _halved(F.col("__column"), h), h))


def _places(placed: DataFrame) -> DataFrame:
    """Count of every part and a real driver of each of its 16 places: ``points`` is never longer than that."""
    finer = F.least(F.col("halvings") + POINT_HALVINGS, F.lit(MAX_HALVINGS))
    points = placed.withColumns({"__r": _halved(F.col("__row"), finer), "__c": _halved(F.col("__column"), finer)}).groupBy(
        "cell", "place", "__r", "__c").agg(F.count(F.lit(1)).alias("n"), F.max("d_lat").alias("lat"), F.max_by("d_lon", "d_lat").alias("lon"))
    return points.groupBy("cell", "place").agg(F.sum("n").alias("n"), F.collect_list(F.struct("lat", "lon")).alias("points"))


def _met(rows: DataFrame, resolution: int) -> DataFrame:
    """Adds the rows and columns of parts of ``cell`` that the circle of ``best_km`` around a rider may meet: __r0 to __r1, __c0 to __c1."""
    # a hair more, so that rounding can never lose the winner
    angle = F.least(F.col("best_km") * dbl((1.0 + 1e-6) / HAVERSINE_KM) + dbl(1e-12), dbl(math.pi))
    round_pole = F.cos(F.radians("lat"))
    widest = F.when((angle < dbl(1.5)) & (F.sin(angle) < round_pole), F.asin(F.least(F.sin(angle) / round_pole, dbl(1.0)))).otherwise(dbl(math.pi))
    x, y = _offset("lat", "lon", resolution)
    dx = widest * dbl(EARTH_PLANE_KM * (1.0 + 1e-6)) + dbl(1e-9)
    dy = angle * dbl(EARTH_PLANE_KM * (1.0 + 1e-6)) + dbl(1e-9)
    h = F.col("halvings")
    # a circle that reaches half-way round may hold drivers on either side of the turn
    apart = dx >= dbl(math.pi / 2.0 * EARTH_PLANE_KM)
    edges = {"__r0": _step(y - dy, resolution), "__r1": _step(y + dy, resolution),
             "__c0": F.when(apart, F.lit(0)).otherwise(_step(x - dx, resolution)),
             "__c1": F.when(apart, F.lit(2**MAX_HALVINGS - 1)).otherwise(_step(x + dx, resolution))}
    return rows.withColumns({name: _halved(at.cast("bigint"), h) for name, at in edges.items()})


def _prune(rows: DataFrame, boxes: str, worthwhile: Column | None = None) -> DataFrame:
    """Keep, per row, the parts of the array ``boxes`` that may hold the nearest driver."""
    worthwhile = F.lit(True) if worthwhile is None else worthwhile
    lat, lon = F.col("lat"), F.col("lon")
    best = F.least("best_km", F.array_min(F.transform(boxes, lambda b: _reachable_km(lat, lon, b))))
    kept = F.filter(boxes, lambda b: _least_km(lat, lon, b) <= F.col("best_km"))
    narrowed = rows.withColumn("best_km", F.when(worthwhile, best).otherwise(F.col("best_km")))
    opened = narrowed.withColumn("__box", F.explode(F.when(worthwhile, kept).otherwise(F.col(boxes)))).drop(boxes)
    return opened.select("*", "__box.*").drop("__box")


def _worth_opening(rows: DataFrame) -> DataFrame:
    box = F.struct("lat0", "lat1", "lon0", "lon1")
    return rows.filter(_least_km(F.col("lat"), F.col("lon"), box) <= F.col("best_km"))


def _tighten(rows: DataFrame) -> DataFrame:
    """Share the best distance among a rider's few open parts and drop those that fell behind."""
    mine = Window.partitionBy("rider_id")
    return _worth_opening(rows.withColumn("best_km", F.min("best_km").over(mine)))


BOX = ["n", "lat0", "lat1", "lon0", "lon1", "lon_at_lat1"]
RIDER = ["rider_id", "lat", "lon"]


def match_nearest(riders: DataFrame, drivers: DataFrame, resolution: int = 9, k: int = 2,
                  leaf_positions: int = LEAF_POSITIONS) -> DataFrame:
    """Nearest driver (haversine) among the cells within ``k`` steps of the rider's cell, also across the antimeridian.

    ``riders`` has rider_id (unique), lat, lon; ``drivers`` is a state table with
    driver_id, lat, lon and optionally cell.  Riders without a candidate give no
    row; equal distances go to the smaller driver id.
    """
    if "cell" not in drivers.columns:
        drivers = drivers.withColumn("cell", cell_of("lat", "lon", resolution))
    # The written tables serve the summaries, the leaf joins and any retry.
    spots = materialise(_spots(drivers, resolution), "driver-positions")
    boxes = materialise(_summary(spots, ["cell"]).withColumn("halvings", _halvings(F.col("n"), leaf_positions)), "driver-cells")
    sizes = boxes.select("cell", "halvings")
    placed = _with_place(spots.join(sizes, "cell")).select("cell", "place", "driver_id", "d_lat", "d_lon", "__row", "__column", "halvings")
    places = materialise(_places(placed), "driver-parts")

    # What the drivers around a rider's own place put within reach.
    x, y = _offset("lat", "lon", resolution)
    # Riders are written too: pushed below, the test that they have a cell would work out their coordinates many times over.
    asked = materialise(spread(riders.select(*RIDER), *RIDER), "riders")
    asking = asked.withColumn("cell", cell_of("lat", "lon", resolution))
    own = _with_place(asking.join(sizes, "cell", "left").withColumns({"__row": _step(y, resolution), "__column": _step(x, resolution)}))
    near = F.array_min(F.transform("points", lambda p: haversine_km(F.col("lat"), F.col("lon"), p["lat"], p["lon"])))
    seeded = own.join(places.select("cell", "place", "points"), ["cell", "place"], "left").select(
        *RIDER, F.col("cell").alias("__rider_cell"), F.coalesce(near, dbl(float("inf"))).alias("best_km"))

    # Expand the summaries and not the riders: at most 1+3k(k+1) boxes meet in a cell.
    around = (boxes.withColumn("__rider_cell", F.explode(disk_across_seam("cell", resolution, k)))
              .groupBy("__rider_cell")
              .agg(F.collect_list(F.struct("cell", "halvings", *BOX)).alias("__boxes"), F.sum("n").alias("__total")))
    start = seeded.join(around, "__rider_cell").drop("__rider_cell")
    # Where only a few drivers are near, comparing them all is cheaper than sorting out the cells.
    some = F.col("__total") <= FEW
    reachable = F.array_min(F.transform("__boxes", lambda b: _reachable_km(F.col("lat"), F.col("lon"), b)))
    start = start.withColumn("best_km", F.when(~some & (F.col("best_km") == dbl(float("inf"))), reachable).otherwise(F.col("best_km")))
    opened = start.select(*RIDER, "best_km", some.alias("__some"), F.explode("__boxes").alias("__box")).select(
        *RIDER, "best_km", "__some", "__box.*")
    box = F.struct("lat0", "lat1", "lon0", "lon1")
    kept = opened.filter(F.col("__some") | (_least_km(F.col("lat"), F.col("lon"), box) <= F.col("best_km")))
    # written with the parts that are met: the test of their number would repeat how they are found
    met = materialise(_met(kept.select(*RIDER, "best_km", "cell", "halvings"), resolution), "frontier")
    wide = (F.col("__r1") - F.col("__r0") + 1) * (F.col("__c1") - F.col("__c0") + 1) > MAX_LOOKUPS
    lookups = met.filter(~wide).withColumn("__r", F.explode(F.sequence("__r0", "__r1"))).withColumn("__c", F.explode(F.sequence("__c0", "__c1")))
    lookups = lookups.select(*RIDER, "best_km", "cell", _place(F.col("__r"), F.col("__c"), F.col("halvings")).alias("place"))
    crowded_places = places.filter(F.col("n") > leaf_positions).select("cell", "place")
    waiting = met.filter(wide).select(*RIDER, "best_km", "cell")
    if not crowded_places.isEmpty():
        waiting = waiting.unionByName(lookups.join(crowded_places, ["cell", "place"], "left_semi").select(*RIDER, "best_km", "cell").distinct())
        lookups = lookups.join(crowded_places, ["cell", "place"], "left_anti")
    closest = _closest(lookups.join(placed.select("cell", "place", "driver_id", "d_lat", "d_lon"), ["cell", "place"]))

    # Without any unevenly crowded cell there is one step.
    last = waiting.isEmpty()
    compared, depth = [closest if last else materialise(closest, "closest")], 0
    crowded = F.col("n") > leaf_positions
    while not last:
        depth += 1
        answered = compared[-1].select("rider_id", F.col("best.distance_km").alias("__km"))
        left = waiting.join(answered, "rider_id", "left").withColumn("best_km", F.least("best_km", "__km")).drop("__km")
        frontier = materialise(_open(_worth_opening(left) if depth > 1 else left, spots, depth), "frontier")
        last = depth == MAX_DEPTH or frontier.filter(crowded).isEmpty()
        leaves = frontier if last else frontier.filter(~crowded)
        parts = spots.select("cell", "driver_id", "d_lat", "d_lon", _part(depth).alias("part"))
        closest = _closest(leaves.select(*RIDER, "best_km", "cell", "part").join(parts, ["cell", "part"]))
        compared.append(closest if last else materialise(closest, "closest"))
        waiting = frontier.filter(crowded)
    if len(compared) == 1:
        nearest = compared[0]
    else:
        together = compared[0]
        for more in compared[1:]:
            together = together.unionByName(more)
        nearest = together.groupBy("rider_id").agg(F.min("best").alias("best"))
    return nearest.select("rider_id", F.col("best.driver_id").alias("driver_id"),
                          F.col("best.d_lat").alias("driver_lat"), F.col("best.d_lon").alias("driver_lon"),
                          F.col("best.distance_km").alias("distance_km"))


def _closest(pairs: DataFrame) -> DataFrame:
    """The winner of each rider; pairs beyond what is within reach go before the aggregate, which sorts its rows."""
    measured = pairs.withColumn("distance_km", haversine_km("lat", "lon", "d_lat", "d_lon"))
    close = measured.filter(F.col("distance_km") <= F.col("best_km") * dbl(1.0 + 1e-9) + dbl(1e-9))
    return close.groupBy("rider_id").agg(F.min(F.struct("distance_km", "driver_id", "d_lat", "d_lon")).alias("best"))


def _open(crowded: DataFrame, spots: DataFrame, depth: int) -> DataFrame:
    """Replace the crowded parts of the frontier by those of their 16 sub-parts that may hold a nearest driver."""
    keys = ["cell"] if depth == 1 else ["cell", "part"]
    upper = [] if depth == 1 else [_part(depth - 1).alias("part")]
    inside = spots.select("*", *upper).join(crowded.select(*keys).distinct(), keys, "left_semi")
    finer = _summary(inside.withColumn("sub", _part(depth)), [*keys, "sub"])
    listed = finer.groupBy(*keys).agg(F.collect_list(F.struct(F.col("sub").alias("part"), *BOX)).alias("__boxes"))
    waiting = crowded.select(*RIDER, "best_km", *keys)
    return _tighten(_prune(waiting.join(listed, keys).drop("part"), "__boxes"))
