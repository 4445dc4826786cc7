"""Mixing sources to target weights by capped water-filling.

Each source asks for words in proportion to its weight.  No source gives more
than ``max_epochs`` times its words: sources above that cap are clamped and
what they leave is reshared by weight among the rest, until nobody is above.

A document is then repeated whole as many times as its source's rate allows.
The fraction left is filled in a seeded order of the source's documents: those
before the cut are taken once more, those behind are not, and the document on
the cut gives the words still missing, so a source misses its target by less
than one word for each document tied on the cut.

The cut is found without ever ordering a whole source: seeded keys fall into
buckets of about ``BUCKET_ROWS`` rows, bucket sums are added up, and only the
rows of the one bucket that holds the cut are ordered.

Defined cases: null text has no words; a null source is a source of its own,
ordered last; sources without words have target 0; rows that repeat doc_id and
size share the cut evenly; a null doc_id is ordered like the text "null";
an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import global_rank, materialise, text_of, word_count

# The weights of sources in code-point order, repeating, the share of all words, and the cap.
WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
SEED = 7
BUCKET_ROWS = 2_000
KEY_BITS = 24


def water_level(sources: DataFrame, total: float) -> float:
    """Words per unit of weight that use up ``total``; sources whose share is above their cap are clamped.

    Every round is one aggregate over the sources that returns two numbers.
    """
    level, clamped = math.inf, -1
    while True:
        free = F.col("weight") * F.lit(level) <= F.col("cap") if math.isfinite(level) else F.lit(True)
        used, weight, n = sources.agg(
            F.sum(F.when(~free, F.col("cap"))), F.sum(F.when(free, F.col("weight"))), F.sum((~free).cast("long"))).first()
        if not weight or n == clamped:
            return level if math.isfinite(level) else 0.0
        level, clamped = (total - (used or 0)) / weight, n


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, docs, weight and target of each source."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranked = global_rank(sums, "source", "rank", "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    sources = materialise(ranked.select("source", "source_size", "docs", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("cap")), "weights")
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, share * words)
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("cap").cast("double"))).drop("cap")


def seeded_key(seed: int) -> Column:
    """A fixed pseudo-random text for each doc_id."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}")))


def with_epochs(targets: DataFrame) -> DataFrame:
    """Adds the whole repetitions and the words of the fractional one."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return targets.withColumn("whole", F.floor(rate)).withColumn(
        "quota", F.floor(F.col("target") - F.col("whole") * F.col("source_size")))


def cuts(keyed: DataFrame, epochs: DataFrame, rows: int) -> DataFrame:
    """source, cut (the ordered place of the cut) and cut_words (words that each row on it gives)."""
    bits = min(KEY_BITS, max(0, math.ceil(math.log2(max(1, rows / BUCKET_ROWS)))))
    bucket = F.shiftright(F.conv(F.substring("key", 1, KEY_BITS // 4), 16, 10).cast("long"), KEY_BITS - bits)
    placed = keyed.withColumn("bucket", bucket)
    same = F.col("source").eqNullSafe(F.col("_source"))

    def holding(sums: DataFrame, at: str, asked: DataFrame) -> DataFrame:
        """_source, the one value of ``at`` that holds the quota, the words before it as base, and quota."""
        so_far = Window.partitionBy("source").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
        upto = sums.withColumn("after", F.sum("words").over(so_far)).join(asked, same)
        after = F.col("base") + F.col("after")
        return upto.filter((after - F.col("words") < F.col("quota")) & (F.col("quota") <= after)).select(
            "_source", F.col(at).alias(f"_{at}"), (after - F.col("words")).alias("base"), "quota")

    # two levels, so that a window over a source has the square root of its buckets
    sums = materialise(placed.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "sums").withColumn("stretch", F.shiftright("bucket", bits // 2))
    asked = epochs.select(F.col("source").alias("_source"), F.lit(0).cast("long").alias("base"), "quota")
    stretch = holding(sums.groupBy("source", "stretch").agg(F.sum("words").alias("words")), "stretch", asked)
    near = sums.join(stretch.select("_source", "_stretch"), same & (F.col("stretch") == F.col("_stretch")), "left_semi")
    held = holding(near, "bucket", stretch.select("_source", "base", "quota"))
    inside = placed.join(held, same & (F.col("bucket") == F.col("_bucket")))
    tied = inside.groupBy("source", "key", "size", "base", "quota").agg(F.count("*").alias("rows"))
    order = Window.partitionBy("source").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = tied.withColumn("after", F.col("base") + F.sum(F.col("size") * F.col("rows")).over(order))
    before = F.col("after") - F.col("size") * F.col("rows")
    return upto.filter((before < F.col("quota")) & (F.col("quota") <= F.col("after"))).select(
        F.col("source").alias("_source"), F.struct("key", "size").alias("cut"), F.floor((F.col("quota") - before) / F.col("rows")).alias("cut_words"))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The narrow rows (doc_id, source, size, key) and, per source, everything needed to tell what a row gives."""
    sized = materialise(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(text_of()).alias("size"), seeded_key(seed).alias("key")), "sizes")
    epochs = materialise(with_epochs(source_targets(sized, weights, share, max_epochs)), "epochs")
    found = cuts(sized, epochs, sized.count())
    plan = epochs.join(found, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "whole", "quota", "cut", "cut_words")
    return sized, materialise(plan, "mix")


def taken_words() -> Column:
    """What a row (key, size) takes part with, given its source's plan."""
    place = F.struct("key", "size")
    extra = F.when(F.col("cut").isNull(), 0).when(place < F.col("cut"), F.col("size")).when(place == F.col("cut"), F.least("size", "cut_words")).otherwise(0)
    return (F.col("whole") * F.col("size") + extra).cast("long")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, source, size, source_size, target and taken for every row of ``docs``."""
    sized, plan = mix_plan(docs, **settings)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", taken_words().alias("taken"))


MIX_COLUMNS = ["size", "source_size", "target", "taken"]


def mixed_documents(docs: DataFrame, seed: int = SEED, **settings) -> DataFrame:
    """The rows of ``docs`` that the mix takes words from, with all their columns and size, source_size, target and taken.

    Columns of ``docs`` that have one of these four names are replaced.  Texts
    are not shuffled.
    """
    _, plan = mix_plan(docs, seed=seed, **settings)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in MIX_COLUMNS]
    keyed = docs.select(F.struct(*kept).alias("_row"), F.col("source").cast("string").alias("source"), word_count(text_of()).alias("size"), seeded_key(seed).alias("key"))
    joined = keyed.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("taken", taken_words()).filter("taken > 0").select("_row.*", *MIX_COLUMNS)


#: The same in SQL over a relation ``{docs}``; the clamped sources are a prefix by cap per weight.
SQL_BODY = r"""
sized AS (
  SELECT *, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':7') AS key
  FROM {docs}
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, 2 * source_size AS cap,
         CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight
  FROM sums
), prefixed AS (
  SELECT *, coalesce(sum(cap) OVER lower, 0) AS used, sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0) AS free
  FROM weighed WINDOW lower AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
  SELECT arg_min(level, used) AS level FROM (
    SELECT (1.5 * (SELECT sum(source_size) FROM sums) - used) / free AS level, weight, cap, used FROM prefixed) WHERE weight * level <= cap
), targets AS (
  SELECT source, source_size, least(weight * level, CAST(cap AS DOUBLE)) AS target FROM weighed, filled
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
), quotas AS (
  SELECT *, CAST(floor(target - whole * source_size) AS BIGINT) AS quota FROM epochs
), placed AS (
  SELECT s.*, q.source_size, q.target, q.whole, q.quota,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY key, size) AS BIGINT) AS upto,
         count(*) OVER (PARTITION BY s.source, key, size) AS tied
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source
), mixed AS (
  SELECT *, whole * size + least(size, greatest(0, quota - (upto - tied * size)) // tied) AS taken FROM placed
)
"""
SQL = "WITH " + SQL_BODY.replace("{docs}", "documents") + "SELECT doc_id, source, size, source_size, target, CAST(taken AS BIGINT) AS taken FROM mixed"
