"""State tables, keyed sinks and reports."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def write_state(df: DataFrame, path: str, by: tuple[str, ...] = ("cell", "driver_id")) -> None:
    """Write a state table range-partitioned and sorted by its key.

    Files then cover disjoint key ranges, so the scan for a cell (a key prefix)
    skips files and row groups by their minimum and maximum.  Ranges are drawn
    over the full key, so a crowded cell still spreads over several files.
    """
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def scan_state(spark: SparkSession, path: str, low: int, high: int, cell: str = "cell") -> DataFrame:
    """Rows whose cell lies in [low, high]; the range reaches the scan."""
    return spark.read.parquet(path).filter(F.col(cell).between(low, high))


def write_matches(df: DataFrame, sink: str | dict[str, str], key: str = "rider_id",
                  checkpoint: str | None = None, run: str | None = None) -> DataStreamWriter | None:
    """Keyed sink for matches or processed pings: a parquet folder, or a topic given as options.

    Batch rows are written at once; for a stream the configured writer is returned.
    Rows of a named ``run`` go to a folder of their own, which a rerun replaces;
    without a name they are appended, so a rerun repeats them.  Keep to one of both in a folder.
    """
    if run is not None and (df.isStreaming or isinstance(sink, dict)):
        raise ValueError("only a batch written to a folder has a run")
    if isinstance(sink, dict):
        df = df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
    if df.isStreaming:
        writer = df.writeStream.outputMode("append")
        writer = writer.format("kafka").options(**sink) if isinstance(sink, dict) else writer.format("parquet").option("path", sink)
        return writer.option("checkpointLocation", checkpoint) if checkpoint else writer
    if isinstance(sink, dict):
        df.write.format("kafka").options(**sink).save()
    elif run is not None:
        df.write.mode("overwrite").parquet(f"{sink}/run={quote(run, safe='')}")
    else:
        df.write.mode("append").parquet(sink)
    return None


def write_outcomes(rows: DataFrame, path: str, reason: str = "reason") -> None:
    """Good and rejected rows in one pass, in folders ``outcome=good`` and ``outcome=quarantine``."""
    outcome = F.when(F.col(reason).isNull(), "good").otherwise("quarantine")
    rows.withColumn("outcome", outcome).write.mode("overwrite").partitionBy("outcome").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Metrics as JSON documents, one per row."""
    df.write.mode("overwrite").json(path)


def report_document(df: DataFrame, out: str = "document") -> DataFrame:
    """The same documents as pretty-printed text."""
    return df.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias(out))


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a stream that commits its progress to ``checkpoint`` once per trigger.

    Without ``every`` it processes what is there and stops, which tests use.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
