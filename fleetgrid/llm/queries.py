"""The registered corpus queries and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontamination, exact_dedup, hard_negatives, html_extraction, merkle, minhash, mixing, quality, recompression, secrets, suffix_dedup,
               url_filters, warc)
from .tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_secret_scans": lambda spark, sf_dir: secrets.scan(table(spark, sf_dir, "documents")),
    "op2_minhash_near_dedup": lambda spark, sf_dir: minhash.near_duplicates(table(spark, sf_dir, "documents")),
    "op3_warc": lambda spark, sf_dir: warc.archived_pages(table(spark, sf_dir, "pages")),
    "op4_url_filters": url_filters.judged_pages,
    "op5_benchmark_decontamination": lambda spark, sf_dir: decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op6_html_extraction": lambda spark, sf_dir: html_extraction.extract(table(spark, sf_dir, "pages")),
    "op7_mixing": lambda spark, sf_dir: mixing.mix(table(spark, sf_dir, "documents")),
    "op8_exact_dedup": lambda spark, sf_dir: exact_dedup.exact_groups(table(spark, sf_dir, "documents")),
    "op9_suffix_array_dedup": lambda spark, sf_dir: suffix_dedup.cut(table(spark, sf_dir, "documents")),
    "op10_quality_classifier": lambda spark, sf_dir: quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op11_substring_dedup": lambda spark, sf_dir: recompression.digests(table(spark, sf_dir, "documents")),
    "op12_merkle_manifest": lambda spark, sf_dir: merkle.verified_rows(table(spark, sf_dir, "documents")),
    "op13_hard_negatives": lambda spark, sf_dir: hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings")),
}
ORACLES: dict[str, str] = {
    "op4_url_filters": url_filters.SQL,
    "op7_mixing": mixing.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
