"""Batch and streaming readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import PING
from .codecs import Decoded, decode_binary, decode_csv, decode_json


BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def read_raw(spark: SparkSession, src: str | dict[str, str], streaming: bool = False,
             max_per_trigger: int | None = None, binary: bool = False) -> DataFrame:
    """Payload rows (``value``) from a folder, or from a topic when ``src`` is a dict of options.

    A folder holds text files with a payload per line, or with ``binary`` files
    that are one payload each; bytes are taken as they are.

    ``max_per_trigger`` bounds the intake of each micro-batch: offsets for a
    topic, files for a folder.
    """
    reader = spark.readStream if streaming else spark.read
    if isinstance(src, dict):
        options = {"startingOffsets": "earliest", **src}
        if streaming and max_per_trigger:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return reader.format("kafka").options(**options).load()
    if streaming and max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    if binary:
        # file streams need the source's fixed schema spelt out
        read = reader.schema(BINARY_FILE) if streaming else reader
        return read.format("binaryFile").load(src).select(F.col("content").alias("value"))
    return reader.format("text").load(src)


def read_pings(spark: SparkSession, src: str | dict[str, str], format: str = "json", streaming: bool = False,
               max_per_trigger: int | None = None, schema: T.StructType = PING) -> Decoded:
    """Decoded pings and the quarantine of payloads that could not be read."""
    raw = read_raw(spark, src, streaming, max_per_trigger, binary=format not in ("json", "csv"))
    if format == "json":
        return decode_json(raw.select(F.col("value").cast("string").alias("value")), schema)
    if format == "csv":
        return decode_csv(raw.select(F.col("value").cast("string").alias("value")), "ping")
    return decode_binary(raw.select("value"), format)


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType,
                      max_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream of its files."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.parquet(folder)


SLICE_FILE_ROWS = 100_000  # of the largest slice in one file


def write_slices(df: DataFrame, path: str, order: str, slices: int, file_rows: int = SLICE_FILE_ROWS) -> int:
    """Writes a table as slices that follow ``order`` (a whole number), one after the other, and returns the number of files of a slice.

    Every slice has that many files, which is what a stream takes in turn with it as
    ``max_per_trigger``; they grow in number with the table and not in length, so
    a slice is written and read by many tasks.
    """
    low, high = df.agg(F.min(order), F.max(order)).first()
    if low is None:
        df.coalesce(1).write.mode("append").parquet(path)
        return 1
    number = F.floor((F.col(order) - low) * slices / (high - low + 1))
    # one row for each slice
    sizes = {r.number: r.n for r in df.groupBy(number.alias("number")).agg(F.count(F.lit(1)).alias("n")).collect()}
    files = max(1, -(-max(n for i, n in sizes.items() if i is not None) // file_rows))
    for i in range(slices):
        rows = df.filter(number == i)
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(path)
        # a task without rows leaves no file: a short slice is filled up with empty ones
        for _ in range((i + 1) * files - _count_files(df.sparkSession, path)):
            df.limit(0).coalesce(1).write.mode("append").parquet(path)
    return files


def _count_files(spark: SparkSession, path: str) -> int:
    """Data files of a written folder."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-*")
    return len(pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern))


def union_topics(topics: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of several topics, each row tagged with its topic; missing columns become null."""
    tagged = [df.withColumn("topic", F.lit(name)) for name, df in topics.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_topics(spark: SparkSession, sources: dict[str, str | dict[str, str]], streaming: bool = False,
                max_per_trigger: int | None = None) -> DataFrame:
    """Everything from the earliest offset of several topics, tagged by topic."""
    return union_topics({name: read_raw(spark, src, streaming, max_per_trigger).select("value") for name, src in sources.items()})
