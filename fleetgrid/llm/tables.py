"""Reading the given tables and small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path

# What separates words, as a regular expression (Java and SQL engines alike), and the separator bytes.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to a fresh path of the shared folder, compressed hard, and reads it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words; only blanks separate words."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def global_rank(df: DataFrame, column: str, rank: str, label: str) -> DataFrame:
    """Adds ``rank``: 0, 1, 2, ... by ``column`` (distinct values, null last).

    Rows are dealt by range and numbered within each range; only one count per
    range meets in one place, never the rows.
    """
    # the ranges are sampled, so the dealt rows are written before they are read twice
    dealt = materialise(df.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("_part", F.spark_partition_id()), label)
    before = Window.orderBy(F.col("_low").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("_part").agg(F.count("*").alias("_n"), F.min(column).alias("_low")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(column).asc_nulls_last()))
    return dealt.join(parts, "_part").withColumn(rank, within - 1 + F.col("_before")).drop("_part", "_before")
