"""An equal-area hexagon grid written as plain arithmetic.

Points go through the Lambert cylindrical equal-area projection and then onto
pointy-top hexagons in axial coordinates.  Each resolution has hexagons seven
times smaller than the one before.  An id is ``resolution | q | r``.  A cell that
reaches past a pole has no centre.

The antimeridian cuts cells in two.  One turn around the globe is no whole number
of hexagons, but the nearest whole number of them maps the grid onto itself, so
an id and the id turned by it are the same place to within half a cell.
``disk_across_seam`` joins the two sides that way.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .scalar import ColumnLike, col, dbl, let, spread

# Fixed values of the grid.
EARTH_KM = 6371.0088
EDGE_KM_RES9 = 0.1743
OFFSET = 1 << 25
FIELD = (1 << 26) - 1
MAX_GRID_RESOLUTION = 12

CELL_BLOCK = 4096  # neighbouring cells of a row that one input row opens into
SMALL_DISK = 8  # steps, up to which the offsets of a disk are written into the plan
WIDE_DISK = 50  # steps, from which on the rows of one disk are dealt to several tasks


def edge_km(resolution: int) -> float:
    return EDGE_KM_RES9 * 7.0 ** ((9 - resolution) / 2)


def _project(lat: Column, lon: Column) -> tuple[Column, Column]:
    return dbl(EARTH_KM) * F.radians(lon), dbl(EARTH_KM) * F.sin(F.radians(lat))


def _scaled(x: Column, y: Column, resolution: int) -> tuple[Column, Column]:
    edge = edge_km(resolution)
    return x * dbl(math.sqrt(3.0) / 3.0 / edge), y * dbl(1.0 / edge)


def _nearest(u: Column, v: Column) -> tuple[Column, Column]:
    """Axial coordinates of the hexagon around the scaled point (u, v).

    Three families of parallel lines cut the plane into half-hexagon strips;
    the strip numbers give the hexagon without a single branch, which keeps the
    expression small and lets code generation share its parts.
    """
    strip = F.floor(u + v + dbl(1.0))
    r = F.floor((strip + (v - u) + dbl(1.0)) / dbl(3.0))
    q = F.floor((strip + u * dbl(2.0) + dbl(1.0)) / dbl(3.0)) - r
    return q, r


def round_axial(q: Column, r: Column) -> tuple[Column, Column]:
    """Nearest hexagon to fractional axial coordinates."""
    return _nearest(q + r / dbl(2.0), r * dbl(1.5))


def pack_cell(q: Column, r: Column, resolution: int | Column) -> Column:
    res = F.lit(resolution) if isinstance(resolution, int) else resolution
    return (F.shiftleft(res.cast("bigint"), 52)
            .bitwiseOR(F.shiftleft((q + F.lit(OFFSET)).cast("bigint"), 26))
            .bitwiseOR((r + F.lit(OFFSET)).cast("bigint")))


def cell_of(lat: ColumnLike, lon: ColumnLike, resolution: int) -> Column:
    """The cell holding a point; null when a coordinate is null."""
    x, y = _project(col(lat), col(lon))
    return pack_cell(*_nearest(*_scaled(x, y, resolution)), resolution)


def axial_q(cell: ColumnLike) -> Column:
    return F.shiftright(col(cell), 26).bitwiseAND(F.lit(FIELD)) - F.lit(OFFSET)


def axial_r(cell: ColumnLike) -> Column:
    return col(cell).bitwiseAND(F.lit(FIELD)) - F.lit(OFFSET)


def plane_xy(cell: ColumnLike, resolution: int) -> tuple[Column, Column]:
    """Projected centre in km of a cell of known resolution."""
    q, r = axial_q(cell).cast("double"), axial_r(cell).cast("double")
    edge = edge_km(resolution)
    return (q + r / dbl(2.0)) * dbl(math.sqrt(3.0) * edge), r * dbl(1.5 * edge)


def cell_center(cell: ColumnLike, resolution: int) -> tuple[Column, Column]:
    """Centre latitude and longitude in degrees; null latitude past a pole."""
    x, y = plane_xy(cell, resolution)
    sin_lat = y / dbl(EARTH_KM)
    lat = F.when(F.abs(sin_lat) <= 1.0, F.degrees(F.asin(sin_lat)))
    return lat, F.degrees(x / dbl(EARTH_KM))


def cell_parent(cell: ColumnLike, resolution: int, own: int) -> Column:
    """The coarser cell that holds this cell's centre (approximate containment).

    Two levels shrink a hexagon by exactly seven, so fine centres do fall on
    coarse edges.  Whole-number arithmetic decides those cases the same way
    everywhere; an odd number of levels has an irrational ratio and no ties.
    """
    if resolution == own:
        return col(cell)
    q, r = axial_q(cell), axial_r(cell)
    levels = own - resolution
    if levels % 2:
        shrink = dbl(7.0 ** (-levels / 2))
        up = round_axial(q.cast("double") * shrink, r.cast("double") * shrink)
    else:
        n = 7 ** (levels // 2)
        strip = F.floor((q + r * 2 + n) / n)
        up_r = F.floor((strip * n + r - q + n) / (3 * n))
        up = F.floor((strip * n + q * 2 + r + n) / (3 * n)) - up_r, up_r
    return pack_cell(*up, resolution)


def disk_offsets(k: int) -> list[int]:
    """What to add to an id to reach each of the 1+3k(k+1) cells within ``k`` steps."""
    return [(dq << 26) + dr for dq in range(-k, k + 1) for dr in range(-k, k + 1) if abs(dq + dr) <= k]


def ring_offsets(k: int) -> list[int]:
    """The same for the cells exactly ``k`` steps away."""
    inner = set(disk_offsets(k - 1)) if k else set()
    return [o for o in disk_offsets(k) if o not in inner]


def grid_disk(cell: ColumnLike, k: int) -> Column:
    offsets = F.array(*[F.lit(o).cast("bigint") for o in disk_offsets(k)])
    return F.transform(offsets, lambda o: col(cell) + o)


def wrapped_longitude(lon: ColumnLike) -> Column:
    """The same meridian between -180 and, not included, 180 degrees; longitudes that lie there stay as they are."""
    lon = col(lon)
    return F.when((lon >= dbl(-180.0)) & (lon < dbl(180.0)), lon).otherwise(F.pmod(lon + dbl(180.0), dbl(360.0)) - dbl(180.0))


def seam_columns(resolution: int) -> int:
    """Hexagons of one turn around the globe, to the nearest whole number."""
    return round(2.0 * math.pi * EARTH_KM / (math.sqrt(3.0) * edge_km(resolution)))


def disk_across_seam(cell: ColumnLike, resolution: int, k: int) -> Column:
    """The cells within ``k`` steps, those beyond the antimeridian under the ids that they have there.

    Both halves of a cell that the antimeridian cuts are in the disk.  A cell is
    in the disk of another exactly when that one is in its disk.  Only cells close to
    the antimeridian pay for it; the disk of any other is the plain one.
    """
    plain = grid_disk(cell, k)
    width, half = math.sqrt(3.0) * edge_km(resolution), math.pi * EARTH_KM
    turn = F.lit(seam_columns(resolution) << 26).cast("bigint")
    around = F.concat(plain, F.transform(plain, lambda c: c + turn), F.transform(plain, lambda c: c - turn))
    held = F.filter(around, lambda c: F.abs(plane_xy(c, resolution)[0]) <= dbl(half + width / 2.0))
    near = F.abs(plane_xy(cell, resolution)[0]) >= dbl(half - (k + 1.5) * width)
    return F.when(near, F.array_distinct(held)).otherwise(plain)


def grid_children(df: DataFrame, resolution: int, own: int, cell: str = "cell", out: str = "child") -> DataFrame:
    """One row per finer cell whose centre lies in ``cell``.

    A disk that holds the children is filtered.  A wide one is opened row by
    row, so no array is longer than it is wide, however many levels there are.
    """
    x, y = plane_xy(cell, own)
    q, r = _nearest(*_scaled(x, y, resolution))
    reach = math.ceil(edge_km(own) / (1.5 * edge_km(resolution))) + 1
    if reach <= SMALL_DISK:
        near = df.withColumn(out, F.explode(grid_disk(pack_cell(q, r, resolution), reach)))
        return near.filter(cell_parent(out, own, resolution) == F.col(cell))
    rows = df.withColumns({"__q": q, "__r": r}).withColumn("__dr", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
    if reach > WIDE_DISK:
        rows = spread(rows, cell, "__dr")
    steps = F.sequence(F.greatest(F.lit(-reach), -F.col("__dr") - reach), F.least(F.lit(reach), F.lit(reach) - F.col("__dr")))
    cells = rows.withColumn("__dq", F.explode(steps))
    return (cells.withColumn(out, pack_cell(F.col("__q") + F.col("__dq"), F.col("__r") + F.col("__dr"), resolution))
            .filter(cell_parent(out, own, resolution) == F.col(cell)).drop("__q", "__r", "__dr", "__dq"))


def _inside_margin(cell: ColumnLike, fine: int, coarse: int) -> Column:
    """How far, 0 at the middle and 1 at the rim, a fine centre lies out in its coarse hexagon."""
    u, v = _scaled(*plane_xy(cell, fine), coarse)
    q, r = _nearest(u, v)
    east, north = u - (q + r / dbl(2.0)), v - r * dbl(1.5)
    return F.greatest(F.abs(east + north), F.abs(north - east), F.abs(east * dbl(2.0)))


def boundary_cells_of(cell: ColumnLike, fine: int = 9, k: int = 3, coarse: int = 5) -> Column:
    """Distinct coarse cells touched by the ``k``-disk around a fine cell, sorted.

    A disk that stays clear of the rim has one parent, which plain arithmetic
    can prove; only the cells near a rim pay for expanding their disk.  There
    the outer ring is enough: a coarse hexagon much larger than the disk that
    reaches into it widens outwards, so it holds a cell of the ring as well.
    """
    reach = 2.0 * k * edge_km(fine) / edge_km(coarse)
    primary = cell_parent(cell, coarse, fine)
    if reach >= 1.0:
        near = F.lit(True)
    else:
        near = _inside_margin(cell, fine, coarse) + dbl(reach) >= dbl(1.0 - 1e-9)
    offsets = ring_offsets(k) if reach <= 0.25 and (fine - coarse) % 2 == 0 else disk_offsets(k)
    around = F.array(*[F.lit(o).cast("bigint") for o in offsets])
    touched = F.transform(F.transform(around, lambda o: col(cell) + o), lambda c: cell_parent(c, coarse, fine))
    return F.when(near, F.array_sort(F.array_distinct(touched))).otherwise(F.array(primary))


def _ring_edges(ring: Column) -> Column:
    """Neighbouring corners in pairs, the last one with the first."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda a, b: F.struct(a["lat"].alias("lat_a"), a["lon"].alias("lon_a"), b["lat"].alias("lat_b"), b["lon"].alias("lon_b")))


def _row_latitude(r: Column, resolution: int) -> Column:
    """Latitude of the centres of a row of hexagons; null past a pole."""
    return cell_center(pack_cell(F.lit(0), r, resolution), resolution)[0]


def _spans(rings: DataFrame, resolution: int, ring: str) -> DataFrame:
    """__ring, __r and the half-open ranges [__from, __to) of longitude that lie inside, by the even-odd rule.

    Every edge meets only the rows of hexagons between its ends.  The crossings
    of a row come in pairs, because a closed ring leaves as often as it enters.
    """
    edges = rings.select("__ring", F.explode(_ring_edges(F.col(ring))).alias("__e")).select("__ring", "__e.*").filter("lat_a <> lat_b")
    height = dbl(1.5 * edge_km(resolution))
    low, high = (pick(_project(F.col("lat_a"), F.lit(0.0))[1], _project(F.col("lat_b"), F.lit(0.0))[1]) / height for pick in (F.least, F.greatest))
    met = edges.withColumn("__r", F.explode(F.sequence(F.floor(low), F.ceil(high)))).withColumn("__lat", _row_latitude(F.col("__r"), resolution))
    lat = F.col("__lat")
    met = met.filter((F.col("lat_a") > lat) != (F.col("lat_b") > lat))
    crossing = (F.col("lon_b") - F.col("lon_a")) * (lat - F.col("lat_a")) / (F.col("lat_b") - F.col("lat_a")) + F.col("lon_a")
    rows = met.groupBy("__ring", "__r").agg(F.sort_array(F.collect_list(crossing)).alias("__x"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("__x"), F.lit(2)), lambda i: F.struct(F.get("__x", i - 1).alias("__from"), F.get("__x", i).alias("__to")))
    return rows.select("__ring", "__r", F.explode(pairs).alias("__span")).select("__ring", "__r", "__span.*").filter("__from < __to")


def polygon_cells(polygons: DataFrame, resolution: int, ring: str = "ring", out: str = "cell") -> DataFrame:
    """Cells whose centre lies inside each row's ring (``array<struct<lat,lon>>``), by even-odd in the latitude/longitude plane.

    A scanline fill: edges are cut by the rows of hexagons that they cross, the
    sorted crossings of a row give its ranges, and only the cells of a range are
    made, in blocks that are spread over the cluster.  The cost is rows crossed by
    edges plus cells; no cell is compared with an edge.
    """
    # equal rings are filled once; their digest stands for them in the exchanges
    keyed = polygons.withColumn("__ring", F.sha2(F.to_json(ring), 256))
    spans = _spans(polygons.select(ring).distinct().withColumn("__ring", F.sha2(F.to_json(ring), 256)), resolution, ring)
    width = dbl(math.sqrt(3.0) * edge_km(resolution))
    first, last = (dbl(EARTH_KM) * F.radians(c) / width - F.col("__r") / dbl(2.0) for c in ("__from", "__to"))
    ranges = spans.withColumns({"__first": F.floor(first) - 1, "__last": F.ceil(last) + 1})
    blocks = keyed.join(ranges, "__ring").withColumn("__block", F.explode(F.sequence("__first", "__last", F.lit(CELL_BLOCK).cast("bigint"))))
    cells = spread(blocks, "__ring", "__r", "__block").withColumn("__q", F.explode(F.sequence(
        F.col("__block"), F.least(F.col("__block") + CELL_BLOCK - 1, F.col("__last")))))
    cells = cells.withColumn(out, pack_cell(F.col("__q"), F.col("__r"), resolution))
    inside = let(cell_center(out, resolution)[1], lambda lon: (lon >= F.col("__from")) & (lon < F.col("__to")))
    return cells.filter(inside).select(*polygons.columns, out)
