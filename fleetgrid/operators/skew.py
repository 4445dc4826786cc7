"""Partition counts and the eight published skew measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import lat_band
from ..functions.scalar import dbl, half_up, round2

# Fixed value: the partition count two of the measures are defined over.
FIXED_PARTITIONS = 60
LOCALITY_PARTITIONS = 12
BALANCE_LIMIT_PCT = 10.0


def partition_counts(df: DataFrame, partition: str = "partition") -> DataFrame:
    return df.groupBy(F.col(partition).alias("partition")).agg(F.count(F.lit(1)).alias("records"))


def partition_band_counts(df: DataFrame, partitioner: str, partition: str = "partition", lat: str = "lat") -> DataFrame:
    """Records per partition and ten-degree latitude band."""
    return (df.groupBy(F.lit(partitioner).alias("partitioner"), F.col(partition).alias("partition"),
                       lat_band(lat).alias("lat_band"))
            .agg(F.count(F.lit(1)).alias("records")))


def with_empty_partitions(counts: DataFrame, n: int) -> DataFrame:
    """Counts for all of 0..n-1; partitions nobody wrote to count 0."""
    every = counts.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"))
    return every.join(counts, "partition", "left").select("partition", F.coalesce("records", F.lit(0)).alias("records"))


def _guarded(value: Column, condition: Column, otherwise: float | None) -> Column:
    return F.when(condition, value).otherwise(F.lit(otherwise).cast("double"))


def skew(counts: DataFrame, kind: str, n: int | None = None) -> DataFrame:
    """One skew figure over per-partition counts.

    a  largest relative deviation from total/n in percent (n = 60)
    b  stddev / mean over the partitions seen; 0 when there are none
    c  stddev over the partitions seen
    d  max / min to two places; null unless min > 0
    e  max / mean over a fixed 12 partitions; 1 when empty
    f  max / mean over all n partitions; 1 when empty
    g  100 * stddev / mean over all n partitions (n = 60)
    h  100 * (max - mean) / mean over all n partitions (n = 60); 0 when empty
    """
    size = n or (LOCALITY_PARTITIONS if kind == "e" else FIXED_PARTITIONS)
    base = with_empty_partitions(counts, size) if kind in "efgh" else counts
    records = F.col("records").cast("double")
    stats = base.agg(F.count(F.lit(1)).alias("seen"), F.coalesce(F.sum("records"), F.lit(0)).alias("total"),
                     F.max(records).alias("high"), F.min(records).alias("low"),
                     F.avg(records).alias("mean"), F.stddev_pop(records).alias("spread"))
    high, low, mean, spread = (F.col(c) for c in ("high", "low", "mean", "spread"))
    some = F.col("total") > 0
    expected = F.col("total") / dbl(float(size))
    value = {
        "a": lambda: _guarded(F.greatest(F.abs(high - expected), F.abs(low - expected)) / expected * dbl(100.0), some, None),
        "b": lambda: _guarded(spread / mean, some, 0.0),
        "c": lambda: F.coalesce(spread, dbl(0.0)),
        "d": lambda: _guarded(round2(high / low), low > 0, None),
        "e": lambda: _guarded(high / expected, some, 1.0),
        "f": lambda: _guarded(high / mean, some, 1.0),
        "g": lambda: _guarded(spread / mean * dbl(100.0), some, None),
        "h": lambda: _guarded((high - mean) / mean * dbl(100.0), some, 0.0),
    }[kind]()
    out = stats.select(F.lit(kind).alias("kind"), value.alias("skew"))
    return out.withColumn("balanced", F.col("skew") <= BALANCE_LIMIT_PCT) if kind == "a" else out


def distribution_report(counts: DataFrame, n: int = FIXED_PARTITIONS) -> DataFrame:
    """Active partitions in order, each with its share of the mean in percent.

    The window runs over at most ``n`` pre-aggregated rows.
    """
    everything = Window.partitionBy()
    mean = F.sum("records").over(everything) / dbl(float(n))
    active = counts.filter("records > 0")
    return (active.select("partition", "records", F.count(F.lit(1)).over(everything).alias("active_partitions"),
                          half_up(F.col("records") / mean * dbl(100.0), 6).alias("pct_of_mean"))
            .orderBy("partition"))


def counts_map(counts: DataFrame) -> DataFrame:
    """One map of partition -> records (one entry per partition)."""
    entries = F.array_sort(F.collect_list(F.struct("partition", "records")))
    return counts.agg(F.map_from_entries(entries).alias("records_by_partition"))
