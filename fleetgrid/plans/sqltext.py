"""SQL text for the comparison engine: the inputs and the shared expressions.

Written independently of the DataFrame code, in the dialect of DuckDB.
"""

from __future__ import annotations

import math

EDGE9, RADIUS = 0.1743, 6371.0088


def num(value: float) -> str:
    """A DOUBLE literal (a bare decimal would be a DECIMAL)."""
    text = repr(float(value))
    return text if "e" in text else f"{text}e0"


def edge(res: int) -> float:
    return EDGE9 * 7.0 ** ((9 - res) / 2)


def _share(expr: str, modulus: int) -> str:
    return f"(CAST(({expr}) % {modulus} AS DOUBLE) / CAST({modulus} AS DOUBLE))"


_E, _N = _share("event_id*7919 + user_id*104729", 10007), _share("event_id*6101 + user_id*15485863", 10009)
_STATUS = "CASE event_type WHEN 'error' THEN 'OFFLINE' WHEN 'purchase' THEN 'ON_TRIP' ELSE 'AVAILABLE' END"

PINGS = f"""(SELECT event_id, user_id, concat('driver-', CAST(user_id AS VARCHAR)) AS driver_id,
  {num(40.4774)} + {num(0.4402)} * {_E} AS lat, {num(-74.2591)} + {num(0.5588)} * {_N} AS lon,
  epoch_us(ts) // 1000 AS ts_ms, ts AS event_ts, {_STATUS} AS status FROM events)"""
WORLD = f"""(SELECT * REPLACE ({num(-85.0)} + {num(170.0)} * {_E} AS lat, {num(-180.0)} + {num(360.0)} * {_N} AS lon) FROM {PINGS})"""
FLAWED = f"""(SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN '  ' ELSE driver_id END AS driver_id,
  CASE WHEN event_id % 89 = 0 THEN {num(95.0)} ELSE lat END AS lat,
  CASE WHEN event_id % 83 = 0 THEN {num(-181.0)} ELSE lon END AS lon) FROM {PINGS})"""
RIDERS = f"""(SELECT o_orderkey AS order_id, concat('rider-', CAST(o_orderkey AS VARCHAR)) AS rider_id,
  {num(40.4774)} + {num(0.4402)} * {_share("o_orderkey*6007 + o_custkey*7561", 10037)} AS lat,
  {num(-74.2591)} + {num(0.5588)} * {_share("o_orderkey*4903 + o_custkey*9811", 10039)} AS lon,
  1704067200000 + ((o_orderkey*86413) % 2592000)*1000 AS request_ms FROM orders)"""


def at_seam(src: str) -> str:
    """The rows moved east until the antimeridian runs through their middle."""
    moved = f"(lon + {num(253.9797)})"
    return f"""(SELECT * REPLACE (CASE WHEN {moved} < 180 THEN {moved} ELSE {moved} + {num(180.0)} - {num(360.0)} - {num(180.0)} END AS lon) FROM {src})"""


ONES = sum(1 << (3 * i) for i in range(15))
H3_IDS = f"""(SELECT * EXCLUDE (res_, random_, sevens_, digits_) FROM (SELECT p.*, event_id % 16 AS res_,
  ((event_id % 1000003) * 2654435761 + user_id * 40503) % {1 << 45} AS random_,
  random_ & (random_ >> 1) & (random_ >> 2) & {ONES} AS sevens_,
  CASE WHEN user_id % 5 = 0 THEN random_ ELSE random_ - sevens_ END AS digits_,
  ((CASE WHEN event_id % 11 = 0 THEN 2::BIGINT ELSE 1::BIGINT END) << 59) | (res_ << 52) | ((user_id % 125) << 45)
   | digits_ | ((1::BIGINT << (45 - res_ * 3)) - 1) AS cell FROM {PINGS} p))"""
RUNS = """(SELECT o_orderkey AS order_id, (['none', 'lz4', 'snappy', 'gzip'])[o_orderkey % 4 + 1] AS codec,
  concat('{"driverId":"driver-', CAST(o_custkey AS VARCHAR), '","timestamp":', CAST(o_orderkey AS VARCHAR),
   ',"status":"', o_orderstatus, '"}') AS payload, 10 AS seconds, o_orderstatus <> 'P' AS ok,
  (o_orderkey * 7919 + o_custkey * 31) % 5003 AS latency_ms FROM orders)"""
OFFSETS = """(SELECT CAST(l_orderkey % 12 AS INTEGER) AS partition,
  CAST(floor(sum(l_linenumber) * 9 / 10) AS BIGINT) AS committed_offset, CAST(count(*) * 3 AS BIGINT) AS end_offset
  FROM lineitem GROUP BY 1)"""

_TEMPS = "x_, y_, q_, r_, s_, nq_, nr_, ns_, dq_, dr_, ds_, fq_, fr_"


def _round_and_pack(res: int | str) -> str:
    return f"""-q_ - r_ AS s_, floor(q_ + {num(0.5)}) AS nq_, floor(r_ + {num(0.5)}) AS nr_, floor(s_ + {num(0.5)}) AS ns_,
  abs(nq_ - q_) AS dq_, abs(nr_ - r_) AS dr_, abs(ns_ - s_) AS ds_,
  CASE WHEN dq_ > dr_ AND dq_ > ds_ THEN -nr_ - ns_ ELSE nq_ END AS fq_,
  CASE WHEN NOT (dq_ > dr_ AND dq_ > ds_) AND dr_ > ds_ THEN -nq_ - ns_ ELSE nr_ END AS fr_,
  (CAST({res} AS BIGINT) << 52) | ((CAST(fq_ AS BIGINT) + 33554432) << 26) | (CAST(fr_ AS BIGINT) + 33554432)"""


def _axial(res: int) -> str:
    e = num(edge(res))
    return (f"(x_ * {num(math.sqrt(3.0) / 3.0)} - y_ * {num(1.0 / 3.0)}) / {e} AS q_, "
            f"y_ * {num(2.0 / 3.0)} / {e} AS r_")


def with_cell(src: str, res: int, out: str = "cell", lat: str = "lat", lon: str = "lon") -> str:
    return f"""(SELECT * EXCLUDE ({_TEMPS}) FROM (SELECT t_.*, {num(RADIUS)} * radians({lon}) AS x_,
  {num(RADIUS)} * sin(radians({lat})) AS y_, {_axial(res)}, {_round_and_pack(res)} AS {out} FROM {src} t_))"""


def center_xy(cell: str, res: int) -> tuple[str, str]:
    q = f"CAST((({cell} >> 26) & 67108863) - 33554432 AS DOUBLE)"
    r = f"CAST(({cell} & 67108863) - 33554432 AS DOUBLE)"
    return (f"(({q} + {r} / {num(2.0)}) * {num(math.sqrt(3.0) * edge(res))})", f"({r} * {num(1.5 * edge(res))})")


def with_parent(src: str, own: int, res: int, out: str = "parent", cell: str = "cell") -> str:
    q, r = f"(({cell} >> 26) & 67108863) - 33554432", f"({cell} & 67108863) - 33554432"
    if (own - res) % 2:
        shrink = num(7.0 ** (-(own - res) / 2))
        return f"""(SELECT * EXCLUDE (q_, r_, s_, nq_, nr_, ns_, dq_, dr_, ds_, fq_, fr_) FROM (SELECT t_.*,
  CAST({q} AS DOUBLE) * {shrink} AS q_, CAST({r} AS DOUBLE) * {shrink} AS r_, {_round_and_pack(res)} AS {out} FROM {src} t_))"""
    # whole numbers: centres lie exactly on coarse edges, which rounding must decide alike everywhere
    n = 7 ** ((own - res) // 2)
    return f"""(SELECT * EXCLUDE (q_, r_, t_, v_, w_) FROM (SELECT s0_.*, {q} AS q_, {r} AS r_,
  CAST(floor((q_ + 2 * r_ + {n}) / {n}) AS BIGINT) AS t_, CAST(floor((t_ * {n} + r_ - q_ + {n}) / {3 * n}) AS BIGINT) AS v_,
  CAST(floor((t_ * {n} + 2 * q_ + r_ + {n}) / {3 * n}) AS BIGINT) - v_ AS w_,
  (CAST({res} AS BIGINT) << 52) | ((w_ + 33554432) << 26) | (v_ + 33554432) AS {out} FROM {src} s0_))"""


def center(cell: str, res: int) -> tuple[str, str]:
    x, y = center_xy(cell, res)
    s = f"({y} / {num(RADIUS)})"
    return (f"CASE WHEN abs({s}) <= 1 THEN degrees(asin({s})) END", f"degrees({x} / {num(RADIUS)})")


def disk(k: int) -> str:
    """Offsets of the k-disk as a one-column relation (d)."""
    return (f"(SELECT (a << 26) + b AS d FROM (SELECT CAST(unnest(range(-{k}, {k + 1})) AS BIGINT) AS a), "
            f"(SELECT CAST(unnest(range(-{k}, {k + 1})) AS BIGINT) AS b) WHERE abs(a + b) <= {k})").replace("(a << 26)", "a * 67108864")


def turn(res: int) -> int:
    """What one turn around the globe adds to an id: the nearest whole number of columns."""
    return round(2.0 * math.pi * RADIUS / (math.sqrt(3.0) * edge(res))) * 67108864


def half_up(expr: str, places: int) -> str:
    scale = num(10.0**places)
    return f"(floor(CAST({expr} AS DOUBLE) * {scale} + {num(0.5)}) / {scale})"


def signed32(expr: str) -> str:
    return f"(CASE WHEN (({expr}) & 4294967295) >= 2147483648 THEN (({expr}) & 4294967295) - 4294967296 ELSE (({expr}) & 4294967295) END)"


def fold32(cell: str) -> str:
    return signed32(f"xor({cell}, ({cell} >> 32))")


def string_hash(text: str) -> str:
    return (f"list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform(string_split({text}, ''), lambda c: CAST(unicode(c) AS BIGINT))), "
            f"lambda a, b: (a * 31 + b) & 4294967295)")


def floor_mod(expr: str, n: int) -> str:
    return f"(((({expr}) % {n}) + {n}) % {n})"


def latest(src: str, keys: str, order: str = "event_id") -> str:
    return (f"(SELECT * EXCLUDE (rn_) FROM (SELECT s_.*, row_number() OVER (PARTITION BY {keys} ORDER BY {order} DESC) AS rn_ "
            f"FROM {src} s_) WHERE rn_ = 1)")


def haversine(a: str, b: str, c: str, d: str) -> str:
    p1, p2 = f"radians({a})", f"radians({c})"
    hl, hn = f"sin(({p2} - {p1}) / {num(2.0)})", f"sin(radians({d} - {b}) / {num(2.0)})"
    h = f"({hl} * {hl} + cos({p1}) * cos({p2}) * {hn} * {hn})"
    return f"({num(2.0 * 6371.0)} * atan2(sqrt({h}), sqrt({num(1.0)} - {h})))"
