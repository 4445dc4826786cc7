"""Ordered per-key computations that survive a key holding a third of all rows.

A window partitioned by a hot key would put that key into one task.  Here the
order of such keys is cut into parts.  A uniform sample of bounded size, taken
in one pass over keys and order columns, tells which keys hold more than their
share of the rows and where their order is cut; a row's part is a column that
follows from the row alone.  All rows are then exchanged once, by (keys, part),
which is the clustering that the windows need.  What a part must know of the
earlier ones is a row or a few per part, found before the exchange and sent to
the parts.  Where no key is large that is a plain window.

Keys may be null, and order columns of any sortable type.  Rows that tie on all
order columns are told apart by a hash of their columns and by their place in
the input; where ties are as many as a part, parts are cut between them too.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cmp_to_key

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

Build = Callable[[WindowSpec], dict[str, Column]]
Order = str | list[str]

TIE, PART = "__tie", "__part"
SAMPLES = 20  # sampled rows for each part
SEED = 20_24


def _columns(order: Order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def _same(left: str, right: str, columns: list[str]) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]


def _told_apart(df: DataFrame) -> DataFrame:
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return df.withColumn(TIE, F.struct(F.xxhash64(*hashed).alias("hash"), F.monotonically_increasing_id().alias("id")))


@dataclass(frozen=True)
class Cuts:
    """Large keys with the ordered values of ``along`` at which their parts begin; ``table`` is None where there are none."""

    keys: list[str]
    along: list[str]
    table: DataFrame | None


def _compare(a, b) -> int:
    """The engine's order of two values: null first, then whatever they hold."""
    if isinstance(a, tuple) and isinstance(b, tuple):
        return next((c for c in map(_compare, a, b) if c), 0)
    if a is None or b is None:
        return (a is not None) - (b is not None)
    if a != a or b != b:  # not a number comes last
        return (a != a) - (b != b)
    return (a > b) - (a < b)


def _sampled(read: DataFrame, keys: list[str], along: list[str]) -> list[tuple]:
    """Large keys, each with the values of ``along`` where its parts begin."""
    parts = int(read.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # every task keeps its lowest numbers, so the sample never grows with the rows
    sample = read.select(*[F.col(k).alias(f"__{k}") for k in keys], *along).withColumn("__random", F.rand(SEED)).orderBy("__random").limit(parts * SAMPLES)
    by_key: dict[tuple, list[tuple]] = defaultdict(list)
    for row in sample.drop("__random").collect():
        by_key[tuple(bytes(v) if isinstance(v, bytearray) else v for v in row[:len(keys)])].append(tuple(row[len(keys):]))
    return [(*key, sorted(rows, key=cmp_to_key(_compare))[SAMPLES - 1:len(rows) - 1:SAMPLES]) for key, rows in by_key.items() if len(rows) >= 2 * SAMPLES]


def find_cuts(df: DataFrame, keys: list[str], order: Order) -> Cuts:
    """A key of at least two parts' rows is cut, about evenly; there are no more cuts than shuffle partitions."""
    along, read = _columns(order), df
    rows = _sampled(df, keys, along)
    if any(len({repr(c) for c in r[-1]}) < len(r[-1]) for r in rows):
        along, read = [*along, TIE], _told_apart(df)
        rows = _sampled(read, keys, along)
    if not rows:
        return Cuts(keys, along, None)
    cut = T.ArrayType(T.StructType([T.StructField(c, read.schema[c].dataType) for c in along]))
    schema = T.StructType([*[T.StructField(k, read.schema[k].dataType) for k in keys], T.StructField("__cuts", cut)])
    return Cuts(keys, along, df.sparkSession.createDataFrame(rows, schema))


@dataclass(frozen=True)
class Series:
    """Rows with ``TIE`` and ``PART``: -1 where the key is not cut, else the stretch of its order that a row lies in."""

    rows: DataFrame
    keys: list[str]
    along: list[str]
    columns: list[str]
    cut: bool

    def window(self) -> WindowSpec:
        # without cuts the part is the same everywhere
        return Window.partitionBy(*self.keys, *([PART] if self.cut else [])).orderBy(*self.along)

    def large(self) -> DataFrame:
        return self.rows.filter(F.col(PART) >= 0)

    def frame(self, *more: str) -> DataFrame:
        return self.rows.select(*self.columns, *more)


def series(df: DataFrame, keys: list[str], order: Order, cuts: Cuts | None = None) -> Series:
    """``cuts`` may come from another table with the same large keys, and from leading order columns only."""
    cuts = cuts or find_cuts(df, keys, order)
    rows = _told_apart(df)
    if cuts.table is None:
        rows = rows.withColumn(PART, F.lit(-1))
    else:
        table = F.broadcast(cuts.table)
        if keys:
            joined = rows.alias("l").join(table.alias("c"), _same("l", "c", keys), "left").select("l.*", "c.__cuts")
        else:
            joined = rows.crossJoin(table)  # of a single row
        here = F.struct(*cuts.along)
        part = F.size(F.filter("__cuts", lambda c: c <= here))
        rows = joined.withColumn(PART, F.when(F.col("__cuts").isNull(), -1).otherwise(part)).drop("__cuts")
    return Series(rows, keys, [*_columns(order), TIE], df.columns, cuts.table is not None)


def deal(df: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """Adds the number of a row's part; the parts of a key follow its order."""
    return series(df, keys, order).rows


def _carried(dealt: Series, total: Column, fold: Callable[[str], Column]) -> DataFrame:
    """(keys, part, __carry): what the earlier parts of large keys come to; no more rows than there are cuts."""
    earlier = Window.partitionBy(*dealt.keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.large().groupBy(*dealt.keys, PART).agg(total.alias("__total")).withColumns({
        "__carry": fold("__total").over(earlier), "__earlier": F.count("*").over(earlier)})
    return placed.filter("__earlier > 0").select(*dealt.keys, PART, "__carry")


def _with_carry(dealt: Series, local: DataFrame, carry: DataFrame) -> DataFrame:
    return local.alias("l").join(F.broadcast(carry.alias("s")), _same("l", "s", [*dealt.keys, PART]), "left").select("l.*", "s.__carry")


def number_rows(df: DataFrame, keys: list[str], order: Order, out: str = "row_number") -> DataFrame:
    """``row_number()`` per key from 1."""
    dealt = series(df, keys, order)
    local = dealt.rows.withColumn("__local", F.row_number().over(dealt.window()))
    if not dealt.cut:
        return local.select(*df.columns, F.col("__local").cast("bigint").alias(out))
    joined = _with_carry(dealt, local, _carried(dealt, F.count("*"), F.sum))
    return joined.select(*df.columns, (F.coalesce("__carry", F.lit(0)) + F.col("__local")).cast("bigint").alias(out))


def running(df: DataFrame, keys: list[str], order: Order, source: str, how: str, out: str) -> DataFrame:
    """Running ``sum`` or ``max`` of ``source`` per key, nulls ignored."""
    fold = {"sum": F.sum, "max": F.max}[how]
    dealt = series(df, keys, order)
    inside = dealt.window().rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.rows.withColumn("__local", fold(source).over(inside))
    own = F.coalesce("__local", F.lit(0)) if how == "sum" else F.col("__local")
    if not dealt.cut:
        return local.select(*df.columns, own.alias(out))
    joined = _with_carry(dealt, local, _carried(dealt, fold(source), fold))
    value = F.coalesce("__carry", F.lit(0)) + own if how == "sum" else F.greatest("__carry", "__local")
    return joined.select(*df.columns, value.alias(out))


def _with_tails(dealt: Series, back: int) -> DataFrame:
    """The rows, and copies (not ``__own``) in each part of a large key of the last ``back`` rows before it."""
    columns = [c for c in dealt.rows.columns if c != PART]
    # the engine keeps no more than that many rows of a part in a task before it sends them
    last = F.row_number().over(Window.partitionBy(*dealt.keys, PART).orderBy(*[F.col(c).desc_nulls_last() for c in dealt.along]))
    tails = dealt.large().withColumn("__last", last).filter(F.col("__last") <= back)
    # a row for each large key; it holds no more than ``back`` rows for each of its parts
    held = tails.groupBy(*[F.col(k).alias(f"__{k}") for k in dealt.keys]).agg(
        F.collect_list(F.struct(F.col(PART).alias("part"), F.col("__last").alias("last"), F.struct(*columns).alias("row"))).alias("__tails"))
    later = lambda a, b: (a["part"] > b["part"]) | ((a["part"] == b["part"]) & (a["last"] < b["last"]))
    lined = held.withColumn("__tails", F.array_sort("__tails", lambda a, b: F.when(later(a, b), 1).otherwise(-1)))
    goals = lined.select("__tails", F.explode(F.array_distinct("__tails.part")).alias("__goal"))
    before = goals.select("__goal", F.filter("__tails", lambda t: t["part"] < F.col("__goal")).alias("__before"))
    sent = before.select("__goal", F.explode(F.slice("__before", F.greatest(F.size("__before") - back + 1, F.lit(1)), back)).alias("__t"))
    copies = sent.select("__t.row.*", F.col("__goal").alias(PART), F.lit(False).alias("__own"))
    return dealt.rows.withColumn("__own", F.lit(True)).unionByName(copies)


def looked_back(dealt: Series, back: int, *builds: Build) -> Series:
    """Adds the window columns of each of ``builds`` in turn; together they reach no more than ``back`` rows back."""
    rows, made = _with_tails(dealt, back) if dealt.cut else dealt.rows, []
    for build in builds:
        columns = build(dealt.window())
        rows = rows.withColumns(columns)
        made += columns
    return replace(dealt, rows=rows.filter("__own").drop("__own") if dealt.cut else rows, columns=list(dict.fromkeys([*dealt.columns, *made])))


def look_back(df: DataFrame, keys: list[str], order: Order, back: int, *builds: Build, cuts: Cuts | None = None) -> DataFrame:
    """Add the window columns of ``builds``, which together reach no more than ``back`` rows back.

    The last ``back`` rows of a large key before a part are copied to that part,
    so every row sees all it needs; the copies are dropped afterwards.
    """
    return looked_back(series(df, keys, order, cuts), back, *builds).frame()


def since_reset(dealt: Series, value: str, reset: str, out: str) -> Series:
    """The sum of ``value`` after the last row with ``reset``, which itself counts nothing, or from the beginning."""
    inside = dealt.window().rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.rows.withColumn("__sum", F.sum(value).over(inside)).withColumn(
        "__mark", F.last(F.when(F.col(reset), F.col("__sum")), ignorenulls=True).over(inside))
    streak = F.col("__sum") - F.coalesce("__mark", F.lit(0))
    columns = [*dealt.columns, out]
    if not dealt.cut:
        return replace(dealt, rows=local.withColumn(out, streak).drop("__sum", "__mark"), columns=columns)
    mine = Window.partitionBy(*dealt.keys).orderBy(PART)
    earlier = mine.rowsBetween(Window.unboundedPreceding, -1)
    ends = local.filter(F.col(PART) >= 0).groupBy(*dealt.keys, PART).agg(F.max_by(F.struct("__sum", "__mark"), F.struct(*dealt.along)).alias("__end"))
    sums = ends.withColumns({"__upto": F.sum("__end.__sum").over(mine), "__before": F.sum("__end.__sum").over(earlier)})
    # what had been summed up in all parts when the last reset came
    at_reset = F.when(F.col("__end.__mark").isNotNull(), F.col("__upto") - F.col("__end.__sum") + F.col("__end.__mark"))
    carry = sums.withColumn("__reset", at_reset).withColumn("__last", F.last("__reset", ignorenulls=True).over(earlier)).filter(
        F.col("__before").isNotNull()).select(*dealt.keys, PART, (F.col("__before") - F.coalesce("__last", F.lit(0))).alias("__carry"))
    rows = _with_carry(dealt, local, carry).withColumn(
        out, F.when(F.col("__mark").isNull(), streak + F.coalesce("__carry", F.lit(0))).otherwise(streak)).drop("__sum", "__mark", "__carry")
    return replace(dealt, rows=rows, columns=columns)
