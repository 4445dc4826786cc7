"""Exact order statistics without sorting everything in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.binary import double_bits
from ..session import materialise

# Rank of a percentile in a sorted sample, counted from 0.
#   i  floor(p*n)          j  ceil(p*n) - 1 (nearest rank)          k  p*n of a sample of 10,000
KINDS = "ijk"
BITS = 64
ROUND_BITS = 16  # of a value that a round decides
LAST_SAMPLES = 10_000


def _rank(kind: str, p: float, n: Column) -> Column:
    share = F.lit(p).cast("double") * n.cast("double")
    rank = (F.ceil(share) - 1) if kind == "j" else F.floor(share)
    return F.greatest(F.least(rank, n - 1), F.lit(0)).cast("bigint")


def last_samples(df: DataFrame, order: str, n: int = LAST_SAMPLES) -> DataFrame:
    """The ``n`` most recent samples (a bounded top-n, merged from per-task top-n lists)."""
    return df.orderBy(F.desc(order)).limit(n)


def ordered_bits(value: Column, kind: T.DataType) -> Column:
    """A whole number of 64 bits that orders values like they order themselves.

    Decimals go by their nearest double, so neighbours may share a number.
    """
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    bits = double_bits(value.cast("double"))
    # of negative numbers a larger size comes first
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def pctl(df: DataFrame, value: str, kind: str = "j", ps: tuple[float, ...] = (0.99,), round_bits: int = ROUND_BITS) -> DataFrame:
    """Exact percentiles of a column: one row per ``p``, as an element of the sample.

    Radix selection: equal values are merged and counted once, in one reading of
    the input.  A round counts the values by the next leading bits of their
    order and keeps for each percentile the slice that holds its rank; after all
    rounds that is one value.  Every round is a count into at most
    ``2 ** round_bits`` slices, whatever the number of values.
    """
    bits = ordered_bits(F.col("v"), df.schema[value].dataType)
    counted = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    merged = materialise(counted.withColumn("bits", bits), "value-counts")
    total = merged.agg(F.sum("c").alias("n"))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), _rank(kind, p, F.col("n")).alias("rank")) for p in ps])
    # a row for each percentile: the bits that are known, and the rank among the values that begin with them
    targets = total.filter("n > 0").select(F.inline(wanted)).withColumn("known", F.lit(0).cast("bigint"))
    before = BITS
    while before > 0:
        shift = max(0, before - round_bits)
        targets, before = _narrow(merged, targets, shift, before), shift
    # decimals that share a double are told apart by themselves
    last = merged.join(F.broadcast(targets), F.col("bits") == F.col("known"))
    upto = F.sum("c").over(Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    placed = last.withColumn("upto", upto).filter(F.col("upto") > F.col("rank"))
    return placed.groupBy("p").agg(F.min("v").alias(value)).select("p", value)


def _narrow(merged: DataFrame, targets: DataFrame, shift: int, before: int) -> DataFrame:
    """Adds the bits from ``before`` down to ``shift`` to what is known of each percentile."""
    head = F.shiftright("bits", before) if before < BITS else F.lit(0).cast("bigint")
    # there are as many targets as percentiles
    parts = merged.select("c", head.alias("head"), F.shiftright("bits", shift).alias("slice")).join(F.broadcast(targets), F.col("head") == F.col("known"))
    sizes = parts.groupBy("p", "rank", "slice").agg(F.sum("c").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("p").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0))
    chosen = sizes.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("size")).filter(
        (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
    # written, so that a round does not repeat the ones before it
    return materialise(chosen.select("p", (F.col("rank") - F.col("before")).alias("rank"), F.col("slice").alias("known")), "percentile-round")
