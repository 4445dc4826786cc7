"""Delivery, matching, lag and codec figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bits import cell_resolution
from ..functions.grid import cell_of, polygon_cells
from ..functions.scalar import ColumnLike, col, dbl, round2

# Assumed size ratio per codec, and the producer's batch size.
CODEC_RATIOS = {"none": 1.0, "lz4": 3.0, "snappy": 2.5, "gzip": 6.5}
BATCH_BYTES = 16384.0
TRANSITION_TARGET = 0.05


def delivery_stats(df: DataFrame, ok: ColumnLike = "ok", latency: str = "latency_ms", by: list[str] | None = None) -> DataFrame:
    """Successes, failures, their rates in percent and the mean latency of the successes."""
    good = F.coalesce(col(ok), F.lit(False))
    sums = df.groupBy(*(by or [])).agg(
        F.count_if(good).alias("successes"), F.count_if(~good).alias("failures"),
        F.coalesce(F.sum(F.when(good, F.col(latency))), F.lit(0)).alias("latency_sum"))
    total = F.greatest(F.col("successes") + F.col("failures"), F.lit(1))
    mean = F.when(F.col("successes") == 0, dbl(0.0)).otherwise(F.col("latency_sum") / F.greatest("successes", F.lit(1)))
    return sums.select(*(by or []), "successes", "failures", mean.alias("mean_latency_ms"),
                       (F.col("successes") * dbl(100.0) / total).alias("success_pct"),
                       (F.col("failures") * dbl(100.0) / total).alias("failure_pct"))


def resolution_mix(df: DataFrame, cell: str = "cell") -> DataFrame:
    """How many ids have resolution 9 and 10, and the mean over all ids (others count 0)."""
    res = cell_resolution(cell)
    sums = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(res == 9).alias("res9"), F.count_if(res == 10).alias("res10"))
    mean = (F.col("res9") * dbl(9.0) + F.col("res10") * dbl(10.0)) / F.greatest("total", F.lit(1))
    return sums.withColumn("mean_resolution", F.when(F.col("total") == 0, dbl(0.0)).otherwise(mean))


def resolution_report(pings: DataFrame, polygons: DataFrame, resolutions: list[int], ring: str = "ring") -> DataFrame:
    """Cells needed to cover the polygons at each resolution and the share of them without a ping."""
    # the pings are read once, whatever the number of resolutions
    cell_at = [F.struct(F.lit(res).alias("resolution"), cell_of("lat", "lon", res).alias("cell")) for res in resolutions]
    occupied = pings.select(F.inline(F.array(*cell_at))).distinct().withColumn("seen", F.lit(1))
    needed = [polygon_cells(polygons, res, ring).select(F.lit(res).alias("resolution"), "cell") for res in resolutions]
    cells = reduce(DataFrame.unionByName, needed).distinct()
    counted = cells.join(occupied, ["resolution", "cell"], "left").groupBy("resolution").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("seen").isNull()).alias("empty_cells"))
    # a row for each resolution, also where no cell is needed
    wanted = pings.sparkSession.createDataFrame([(res,) for res in resolutions], "resolution int")
    out = wanted.join(counted, "resolution", "left").na.fill(0, ["cells", "empty_cells"])
    ratio = F.when(F.col("cells") == 0, dbl(0.0)).otherwise(F.col("empty_cells") / F.greatest("cells", F.lit(1)))
    return out.withColumn("empty_ratio", ratio)


def match_summary(riders: DataFrame, matches: DataFrame, latency: str = "latency_ms") -> DataFrame:
    """Requests, matches, latency total and mean, and the share of requests that found a driver."""
    tagged = riders.select(F.lit(0).alias("hit"), F.lit(0).cast("bigint").alias("ms")).unionByName(
        matches.select(F.lit(1).alias("hit"), F.col(latency).cast("bigint").alias("ms")))
    sums = tagged.agg(F.count_if(F.col("hit") == 0).alias("requests"), F.count_if(F.col("hit") == 1).alias("matches"),
                      F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("ms"))), F.lit(0)).alias("latency_sum"))

    def per(top: str, bottom: str, scale: float) -> Column:
        return F.when(F.col(bottom) == 0, dbl(0.0)).otherwise(
            round2(F.col(top) * dbl(scale) / F.greatest(bottom, F.lit(1))))

    return sums.withColumns({"mean_latency_ms": per("latency_sum", "matches", 1.0),
                             "match_pct": per("matches", "requests", 100.0)})


def lag_report(offsets: DataFrame, by: str = "partition") -> DataFrame:
    """Committed and end offset and lag per partition, with a total row where ``by`` is null."""
    return (offsets.withColumn("lag", F.greatest(F.col("end_offset") - F.col("committed_offset"), F.lit(0)))
            .rollup(by).agg(F.sum("committed_offset").alias("committed_offset"), F.sum("end_offset").alias("end_offset"),
                            F.sum("lag").alias("lag"), F.count(F.lit(1)).alias("partitions")))


def topic_totals(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Records per topic and, where the topic is null, in all."""
    return df.rollup(topic).agg(F.count(F.lit(1)).alias("records"))


def distinct_cells(df: DataFrame, cell: str = "cell") -> DataFrame:
    """The set of cells in use."""
    return df.select(cell).distinct()


def distinct_cell_count(df: DataFrame, cell: str = "cell", approximate: bool = False) -> DataFrame:
    how = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(how(F.col(cell)).alias("distinct_cells"))


def has_collisions(df: DataFrame, value: str) -> DataFrame:
    """Whether a value occurs twice: counts per value combine before they travel."""
    per_value = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_values"),
                         F.coalesce(F.max("n") > 1, F.lit(False)).alias("collides"))


def batch_efficiency(runs: DataFrame) -> DataFrame:
    """Batch fill and saved requests in percent, from mean batch bytes, requests per second and events."""
    return runs.withColumns({
        "batch_fill_pct": F.col("batch_bytes_avg") / dbl(BATCH_BYTES) * dbl(100.0),
        "request_cut_pct": (dbl(1.0) - F.col("request_rate") / F.col("events")) * dbl(100.0)})


def codec_report(runs: DataFrame, payload: str = "payload", codec: str = "codec", seconds: str = "seconds") -> DataFrame:
    """Bytes, assumed compressed bytes, rates and saving per codec.

    The ratios are the published estimates.  ``runs`` holds one row per event
    with its text payload, codec and the length of the run in seconds.
    """
    ratio = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in CODEC_RATIOS.items() for v in kv]), F.col(codec)), dbl(1.0))
    sums = runs.groupBy(codec).agg(F.count(F.lit(1)).alias("events"),
                                   F.sum(F.octet_length(payload)).cast("bigint").alias("raw_bytes"),
                                   F.max(seconds).cast("double").alias("run_seconds"))
    sized = sums.withColumn("compressed_bytes", F.floor(F.col("raw_bytes") / ratio))
    measured = sized.withColumn("ratio", F.col("raw_bytes") / F.col("compressed_bytes"))
    return measured.withColumns({
        "events_per_sec": F.floor(F.col("events") / F.col("run_seconds")),
        "bytes_per_sec": F.floor(F.col("compressed_bytes") / F.col("run_seconds")),
        "saving_pct": (dbl(1.0) - dbl(1.0) / F.col("ratio")) * dbl(100.0)})
