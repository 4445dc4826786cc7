"""The corpus pipeline: quality, exact and near copies, benchmark leaks, mixing.

Every stage takes what its predecessor kept, as written Parquet.  All but the
last return the columns of ``documents`` and leave the rows they keep as they
are.  The last returns the mix: a row for each document that the mix takes words
from, with its size, its source's target and the words taken, repeats counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetgrid.llm import decontamination, exact_dedup, minhash, mixing, quality
from fleetgrid.llm.tables import materialise, table


NEAR = 85  # per cent of shared shingles from which the stage links, as the query op2_ does


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised text one stays."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies one document stays."""
    return minhash.keep_one(docs, NEAR)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how much of each."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("source_mixing", source_mix),
]

#: The classifier and the near copies are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
