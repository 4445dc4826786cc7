"""Partition numbers, hashes, placement and balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import binary, bits, hashing
from ..functions.scalar import half_up
from ..operators import metrics, partitioning as P, skew as S
from ..operators.matching import copartition_check, copartition_summary
from ..operators.quality import with_cell
from . import inputs as I, sqltext as Q
from .registry import query

MASK = 4294967295


def _abs_mod(expr: str, n: int) -> str:
    return f"CAST(abs({expr}) % {n} AS INTEGER)"


def _byte(hexed: str, i: str) -> str:
    return f"CAST(('0x' || substr({hexed}, 2 * ({i}) + 1, 2)) AS BIGINT)"


def murmur2_sql(hexed: str) -> str:
    m = 1540483477
    size = f"(length({hexed}) // 2)"
    word = " | ".join(f"({_byte(hexed, f'4 * i + {b}')} << {8 * b})" for b in range(4))
    scrambled = f"(((({word}) * {m}) & {MASK}))"
    k = f"((xor({scrambled}, {scrambled} >> 24) * {m}) & {MASK})"
    body = (f"list_reduce(list_concat([xor(CAST({size} AS BIGINT), 2538058380)], list_transform(range({size} // 4), lambda i: {k})), "
            f"lambda h, w: xor((h * {m}) & {MASK}, w))")
    base = f"4 * ({size} // 4)"
    t = body
    for pos, shift in ((2, 16), (1, 8), (0, 0)):
        t = f"xor({t}, CASE WHEN {size} % 4 > {pos} THEN {_byte(hexed, f'{base} + {pos}')} << {shift} ELSE 0 END)"
    tail = f"CASE WHEN {size} % 4 > 0 THEN (({t}) * {m}) & {MASK} ELSE {body} END"
    # two more rounds through one-element lists, so each value is written once
    third = f"list_transform([{tail}], lambda h: (xor(h, h >> 13) * {m}) & {MASK})"
    return f"(list_transform({third}, lambda h: xor(h, h >> 15))[1])"


def _cell_modes_sql() -> str:
    return f"""SELECT event_id, {_abs_mod('cell', 12)} AS by_mod, CAST(abs(cell % 12) AS INTEGER) AS by_mod_abs,
 {_abs_mod(Q.fold32('cell'), 12)} AS by_fold_abs, CAST({Q.floor_mod(Q.fold32('cell'), 12)} AS INTEGER) AS by_hex_fold_floor FROM {Q.H3_IDS}"""


@query("partition_by_cell", _cell_modes_sql())
def partition_by_cell(spark, d):
    ids = I.h3_ids(spark, d).withColumn("cell_hex", bits.cell_to_hex("cell"))
    return ids.select("event_id", *[P.partition_of(m, 12).alias(f"by_{m}") for m in ("mod", "mod_abs", "fold_abs", "hex_fold_floor")])


def _geohash_partition_sql() -> str:
    from .cells import _geohash_sql
    ok = "lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"
    src = Q.with_cell(f"(SELECT *, {_geohash_sql(6)} AS g FROM {Q.FLAWED})", 9)
    return (f"SELECT event_id, CASE WHEN {ok} THEN {_abs_mod(Q.signed32(Q.string_hash('g')), 12)} ELSE 0 END AS by_geohash, "
            f"CASE WHEN {ok} THEN {_abs_mod('cell', 12)} ELSE 0 END AS by_res9_mod FROM {src}")


@query("partition_by_point", _geohash_partition_sql())
def partition_by_point(spark, d):
    return I.flawed_pings(spark, d).select("event_id", P.partition_of("geohash", 12).alias("by_geohash"),
                                           P.partition_of("res9_mod", 12).alias("by_res9_mod"))


@query("partition_by_json_cell", f"SELECT event_id, CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL ELSE CAST(abs(cell % 12) AS INTEGER) END AS partition "
       f"FROM {Q.with_cell(Q.PINGS, 9)}")
def partition_by_json_cell(spark, d):
    e = F.col("event_id")
    cell = F.when(e % 17 == 0, F.lit("unknown")).otherwise(F.col("cell").cast("string"))
    payload = F.when(e % 13 == 0, F.lit('{"driverId":')).otherwise(F.to_json(F.struct("driver_id", cell.alias("h3Cell"))))
    return P.assign_partition(with_cell(I.pings(spark, d), 9).withColumn("payload", payload), "json_mod", 12).select("event_id", "partition")


_KEY6 = "CASE WHEN event_id % 10 = 0 THEN concat('key-', driver_id) END"


@query("partition_by_key_bytes", f"""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN {_abs_mod(Q.signed32(Q.string_hash("concat('key-', driver_id)")), 12)}
  ELSE {_abs_mod(Q.fold32('cell'), 12)} END AS partition FROM {Q.with_cell(Q.PINGS, 6)}""")
def partition_by_key_bytes(spark, d):
    text = F.concat(F.lit("key-"), F.col("driver_id"))
    keyed = with_cell(I.pings(spark, d), 6).withColumns({
        "key_text": text,
        "key": F.when(F.col("event_id") % 10 == 0, F.encode(text, "UTF-8")).otherwise(binary.put_i64("cell"))})
    return P.assign_partition(keyed, "res6_fold", 12).select("event_id", "partition")


def _bytes_hash_sql(text: str) -> str:
    """Signed-byte polynomial; the keys are ASCII, so a byte is its code point."""
    return Q.string_hash(text).replace("CAST(0 AS BIGINT)", "CAST(1 AS BIGINT)")


_VALUE9 = f"""SELECT event_id, CASE WHEN event_id % 10 = 0 AND event_id % 4 = 0 THEN 0
  WHEN event_id % 10 = 0 THEN {_abs_mod(Q.signed32(_bytes_hash_sql('driver_id')), 64)}
  WHEN lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 THEN {_abs_mod('cell', 64)} ELSE 0 END AS partition FROM {Q.with_cell(Q.FLAWED, 3)}"""


@query("partition_by_value_bytes", _VALUE9)
def partition_by_value_bytes(spark, d):
    e = F.col("event_id")
    packed = F.concat(binary.put_f64("lat"), binary.put_f64("lon"), binary.put_i64("ts_ms"))
    rows = I.flawed_pings(spark, d).withColumns({
        "value": F.when(e % 10 == 0, binary.put_f64("lat")).otherwise(packed),
        "key": F.when(e % 4 != 0, F.encode("driver_id", "UTF-8"))})
    return P.assign_partition(rows, "res3_unsigned", 64).select("event_id", "partition")


def _parent3_sql() -> str:
    from .cells import _h3_parent_sql
    return f"""SELECT event_id, CASE WHEN event_id % 6 = 0 THEN CAST(({murmur2_sql("hex(driver_id)")} & 2147483647) % 60 AS INTEGER)
  ELSE {_abs_mod(Q.fold32('p3'), 60)} END AS partition FROM (SELECT *, {_h3_parent_sql(3)} AS p3 FROM {Q.H3_IDS})"""


@query("partition_by_parent_cell", _parent3_sql())
def partition_by_parent_cell(spark, d):
    e = F.col("event_id")
    rows = I.h3_ids(spark, d).withColumns({
        "key": F.when(e % 12 == 0, F.lit(bytes(4))).when(e % 6 != 0, binary.put_i64("cell")),
        "value": F.encode("driver_id", "UTF-8")})
    return P.assign_partition(rows, "parent3_fold", 60).select("event_id", "partition")


@query("partition_by_city_cell", f"SELECT event_id, CAST({Q.floor_mod(Q.fold32('cell'), 60)} AS INTEGER) AS partition FROM {Q.with_cell(Q.WORLD, 4)}")
def partition_by_city_cell(spark, d):
    return P.assign_partition(I.world_pings(spark, d), "res4_fold_floor", 60).select("event_id", "partition")


@query("salted_cell_key", f"""SELECT event_id, concat(CAST(cell AS VARCHAR), '|', CAST(abs({Q.signed32(Q.string_hash('driver_id'))}) % 8 AS VARCHAR)) AS partition_key
  FROM {Q.with_cell(Q.PINGS, 5)}""")
def salted_cell_key(spark, d):
    return with_cell(I.pings(spark, d), 5).select("event_id", P.salted_key("cell", "driver_id").alias("partition_key"))


@query("partition_by_default_hash", f"""SELECT driver_id, rides, CAST(({murmur2_sql("hex(driver_id)")} & 2147483647) % 60 AS INTEGER) AS partition
  FROM (SELECT driver_id, count(*) AS rides FROM {Q.PINGS} GROUP BY 1)""")
def partition_by_default_hash(spark, d):
    rides = I.pings(spark, d).groupBy("driver_id").agg(F.count(F.lit(1)).alias("rides"))
    return P.assign_partition(rides, "default", 60, key_text="driver_id")


def _seed_sql() -> str:
    two64, m64 = 1 << 64, (1 << 64) - 1
    start = Q.signed32(f"({Q.string_hash('entity')}) + 31")
    wide = f"(CASE WHEN s0 < 0 THEN CAST(s0 AS HUGEINT) + {two64} ELSE CAST(s0 AS HUGEINT) END)::UHUGEINT"
    steps = f"""(SELECT *, {start} AS s0, {wide} AS u0, xor(u0, u0 >> 33) AS u1,
      (u1 * {0xFF51AFD7ED558CCD}::UHUGEINT) & {m64}::UHUGEINT AS u2, xor(u2, u2 >> 33) AS u3,
      (u3 * {0xC4CEB9FE1A85EC53}::UHUGEINT) & {m64}::UHUGEINT AS u4, xor(u4, u4 >> 33) AS u5
      FROM (SELECT rider_id, concat(rider_id, ':rush-hour') AS entity FROM {Q.RIDERS}))"""
    return f"SELECT rider_id, CAST(CASE WHEN u5 >= {1 << 63}::UHUGEINT THEN CAST(u5 AS HUGEINT) - {two64} ELSE CAST(u5 AS HUGEINT) END AS BIGINT) AS seed FROM {steps}"


@query("entity_seed", _seed_sql())
def entity_seed(spark, d):
    return I.riders(spark, d).select("rider_id", hashing.seed_of("rider_id", F.lit("rush-hour")).alias("seed"))


@query("seed_collisions", f"""SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_values, max(n) > 1 AS collides FROM
  (SELECT count(*) AS n FROM ({_seed_sql()}) GROUP BY seed)""")
def seed_collisions(spark, d):
    return metrics.has_collisions(entity_seed(spark, d), "seed")


@query("string_hash", f"SELECT rider_id, {Q.string_hash('rider_id')} AS hashed FROM {Q.RIDERS}")
def string_hash(spark, d):
    return I.riders(spark, d).select("rider_id", hashing.java_hash("rider_id").alias("hashed"))


@query("text_hash_whole_documents", f"SELECT doc_id, {Q.string_hash('text')} AS hashed FROM documents")
def text_hash_whole_documents(spark, d):
    return I.table(spark, d, "documents").select("doc_id", hashing.java_hash("text").alias("hashed"))


@query("physical_placement", f"""SELECT CAST(abs(cell) % 12 AS INTEGER) AS partition, count(*) AS records, CAST(0 AS BIGINT) AS misplaced
  FROM {Q.with_cell(Q.PINGS, 7)} GROUP BY 1""")
def physical_placement(spark, d):
    placed = P.place_by_partition(P.assign_partition(with_cell(I.pings(spark, d), 7), "mod", 12), 12)
    marked = placed.select("partition", F.spark_partition_id().alias("found"))
    return marked.groupBy("partition").agg(F.count(F.lit(1)).alias("records"),
                                           F.count_if(F.col("partition") != F.col("found")).alias("misplaced"))


# ---- balance ---------------------------------------------------------------

def _counts(spark, d):
    return S.partition_counts(P.assign_partition(with_cell(I.pings(spark, d), 7), "fold_abs", 60))


_COUNTS = f"(SELECT {_abs_mod(Q.fold32('cell'), 60)} AS partition, count(*) AS records FROM {Q.with_cell(Q.PINGS, 7)} GROUP BY 1)"
_ALL60 = f"(SELECT range AS partition, coalesce(records, 0) AS records FROM range(60) LEFT JOIN {_COUNTS} c ON c.partition = range)"


@query("partition_counts", f"SELECT partition, records FROM {_COUNTS}")
def partition_counts(spark, d):
    return _counts(spark, d)


@query("partition_band_counts", f"""SELECT 'geo' AS partitioner, {_abs_mod('cell', 12)} AS partition, CAST(floor((lat + 90.0e0) / 10.0e0) AS INTEGER) AS lat_band,
  count(*) AS records FROM {Q.with_cell(Q.WORLD, 5)} GROUP BY ALL""")
def partition_band_counts(spark, d):
    pings = P.assign_partition(with_cell(I.world_pings(spark, d), 5), "mod", 12)
    return S.partition_band_counts(pings, "geo")


_STATS = "max(records) AS hi, min(records) AS lo, avg(records) AS mean, stddev_pop(records) AS sd, sum(records) AS total"
_SKEW_SQL = {
    "a": f"SELECT 'a' AS kind, {Q.half_up('greatest(abs(hi - total / 60.0e0), abs(lo - total / 60.0e0)) / (total / 60.0e0) * 100.0e0', 6)} AS skew, skew <= 10 AS balanced FROM (SELECT {_STATS} FROM {_COUNTS})",
    "b": f"SELECT 'b' AS kind, {Q.half_up('sd / mean', 6)} AS skew FROM (SELECT {_STATS} FROM {_COUNTS})",
    "c": f"SELECT 'c' AS kind, {Q.half_up('sd', 6)} AS skew FROM (SELECT {_STATS} FROM {_COUNTS})",
    "d": f"SELECT 'd' AS kind, CASE WHEN lo > 0 THEN {Q.half_up('hi / lo', 2)} END AS skew FROM (SELECT {_STATS} FROM {_COUNTS})",
    "e": f"SELECT 'e' AS kind, {Q.half_up('hi / (total / 12.0e0)', 6)} AS skew FROM (SELECT {_STATS} FROM (SELECT partition % 12, sum(records) AS records FROM {_COUNTS} GROUP BY 1))",
    "f": f"SELECT 'f' AS kind, {Q.half_up('hi / mean', 6)} AS skew FROM (SELECT {_STATS} FROM {_ALL60})",
    "g": f"SELECT 'g' AS kind, {Q.half_up('sd / mean * 100.0e0', 6)} AS skew FROM (SELECT {_STATS} FROM {_ALL60})",
    "h": f"SELECT 'h' AS kind, {Q.half_up('(hi - mean) / mean * 100.0e0', 6)} AS skew FROM (SELECT {_STATS} FROM {_ALL60})",
}
_SKEW_NAMES = {"a": "deviation_pct", "b": "variation", "c": "stddev", "d": "max_over_min", "e": "max_over_mean_12",
               "f": "max_over_mean", "g": "variation_pct", "h": "excess_pct"}


def _register_skew(kind: str) -> None:
    @query(f"skew_{_SKEW_NAMES[kind]}", _SKEW_SQL[kind])
    def run(spark, d):
        counts = _counts(spark, d)
        if kind == "e":
            counts = counts.groupBy((F.col("partition") % 12).alias("partition")).agg(F.sum("records").alias("records"))
        return S.skew(counts, kind).withColumn("skew", half_up("skew", 6))


for _kind in _SKEW_SQL:
    _register_skew(_kind)


@query("distribution_report", f"""SELECT partition, records, count(*) OVER () AS active_partitions,
  {Q.half_up('records / (sum(records) OVER () / 60.0e0) * 100.0e0', 6)} AS pct_of_mean FROM {_COUNTS} WHERE records > 0""")
def distribution_report(spark, d):
    return S.distribution_report(_counts(spark, d), 60)


@query("partition_count_map", f"SELECT CAST(partition AS INTEGER) AS partition, records FROM {_COUNTS}")
def partition_count_map(spark, d):
    return S.counts_map(_counts(spark, d)).select(F.explode("records_by_partition").alias("partition", "records"))


_SIDE = "(SELECT cell, min(p) AS lo, max(p) AS hi FROM (SELECT cell, {p} AS p FROM {src}) GROUP BY cell)"
_A = _SIDE.format(p=_abs_mod(Q.fold32("cell"), 12), src=Q.with_cell(Q.PINGS, 7))
_B = _SIDE.format(p=f"CAST({Q.floor_mod(Q.fold32('cell'), 12)} AS INTEGER)", src=Q.with_cell(Q.RIDERS, 7))
_CHECK = f"""(SELECT coalesce(a.cell, b.cell) AS cell, CASE WHEN a.cell IS NULL THEN 'b' WHEN b.cell IS NULL THEN 'a' ELSE 'both' END AS side,
  a.lo AS a_partition, b.lo AS b_partition,
  CASE WHEN a.cell IS NOT NULL AND b.cell IS NOT NULL THEN a.lo = a.hi AND b.lo = b.hi AND a.lo = b.lo END AS aligned
  FROM {_A} a FULL JOIN {_B} b ON a.cell = b.cell)"""


def _check(spark, d):
    a = P.assign_partition(with_cell(I.pings(spark, d), 7), "fold_abs", 12)
    b = with_cell(I.riders(spark, d), 7).withColumn("cell_hex", bits.cell_to_hex("cell"))
    return copartition_check(a, P.assign_partition(b, "hex_fold_floor", 12), 12, 12)


@query("copartition_check", f"SELECT cell, side, a_partition, b_partition, aligned FROM {_CHECK}")
def copartition_check_query(spark, d):
    return _check(spark, d)


@query("copartition_summary", f"""SELECT count(*) AS cells, count(*) FILTER (aligned) AS aligned, count(*) FILTER (NOT aligned) AS misaligned,
  count(*) FILTER (aligned IS NULL) AS one_sided FROM {_CHECK}""")
def copartition_summary_query(spark, d):
    return copartition_summary(_check(spark, d))


