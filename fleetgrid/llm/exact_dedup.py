"""Exact deduplication of whole texts behind a two-pass Bloom filter.

Pass one counts, for every bit of a Bloom filter, how many rows set it, and
keeps the bits that were set at least twice: the filter of hashes that *may*
occur again.  Pass two probes every row.  Only rows whose bits are all kept
are shuffled and grouped by their full SHA-256; all others are unique for
certain and pass straight through.  The filter never misses a repeat, so the
result is exact; a wrong hit only costs one more shuffled row.  To learn which
bits are set twice, pass one exchanges two pairs of small numbers for each row,
(block, bit), counted within a task first; no text and no digest travels there.

The filter has at least 16 bits a row in blocks of 32,768 bits.  It is
broadcast only while it is smaller than ``BROADCAST_BYTES``; a larger one is
joined by block.

Defined cases: null text counts as empty; rows with equal text and equal
doc_id all carry the same flag; a null doc_id stays only when no other row of
the group has one; an empty table gives an empty result; other columns are
never looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .tables import SPACES, materialise, text_of

BLOCK_BITS = 32_768  # one bitmap of Spark's bitmap functions
BITS_PER_ROW = 16
BROADCAST_BYTES = 64 << 20


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text with every run of blanks made one space."""
    return F.sha2(F.regexp_replace(text, SPACES, " "), 256)


def block_count(rows: int) -> int:
    """Blocks of the filter, a power of two."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows * BITS_PER_ROW / BLOCK_BITS))))


def with_bits(df: DataFrame, digest: str, blocks: int) -> DataFrame:
    """Adds the block and the two bits of a digest."""
    h = F.xxhash64(digest)
    return df.withColumns({
        "_block": F.shiftrightunsigned(h, 34).bitwiseAND(F.lit(blocks - 1)),
        "_bit1": h.bitwiseAND(F.lit(BLOCK_BITS - 1)),
        "_bit2": F.shiftrightunsigned(h, 17).bitwiseAND(F.lit(BLOCK_BITS - 1))})


def repeat_filter(df: DataFrame) -> DataFrame:
    """Rows (_block, _bitmap): the bits that two or more rows set."""
    bits = df.select("_block", F.explode(F.array_distinct(F.array("_bit1", "_bit2"))).alias("_bit"))
    twice = bits.groupBy("_block", "_bit").agg(F.count("*").alias("_n")).filter("_n > 1")
    return twice.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))


def bit_is_set(bitmap: str, bit: str) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.shiftright(F.col(bit), 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.col(bit).bitwiseAND(F.lit(7)).cast("int")) == 1


def with_suspects(df: DataFrame, digest: str, rows: int, kept_filter: DataFrame) -> DataFrame:
    """Adds ``suspect``: false only for digests that occur once."""
    blocks = block_count(rows)
    probe = F.broadcast(kept_filter) if blocks * BLOCK_BITS // 8 <= BROADCAST_BYTES else kept_filter
    hit = F.col("_bitmap").isNotNull() & bit_is_set("_bitmap", "_bit1") & bit_is_set("_bitmap", "_bit2")
    return with_bits(df, digest, blocks).join(probe, "_block", "left").withColumn(
        "suspect", F.coalesce(hit, F.lit(False))).drop("_block", "_bit1", "_bit2", "_bitmap")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    hashed = materialise(docs.select("doc_id", text_digest(text_of()).alias("text_sha256")), "digests")
    rows = hashed.count()
    marked = with_suspects(hashed, "text_sha256", rows, repeat_filter(with_bits(hashed, "text_sha256", block_count(rows))))
    suspects = marked.filter("suspect").drop("suspect")
    # written, so that the join deals the suspects by itself and the engine may split the rows of a large group
    groups = materialise(suspects.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    columns = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    alone = marked.filter("NOT suspect").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long")})
    return alone.select(*columns).unionByName(suspects.join(groups, "text_sha256").select(*columns))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each text, the one with the smallest doc_id.

    Rows that the filter clears are never shuffled.  Of rows with equal text and
    doc_id one stays.
    """
    digest, row = "_digest", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.col("doc_id").alias("_id"), text_digest(text_of()).alias(digest))
    hashed = materialise(keyed.select(digest), "digests")
    rows = hashed.count()
    marked = with_suspects(keyed, digest, rows, materialise(repeat_filter(with_bits(hashed, digest, block_count(rows))), "repeats"))
    # equal texts, so the other columns break ties between equal ids
    order = F.struct(F.col("_id").isNull(), F.col("_id"), F.to_json("_row"))
    one = marked.filter("suspect").groupBy(digest).agg(F.min_by("_row", order).alias("_row"))
    return marked.filter("NOT suspect").select("_row.*").unionByName(one.select("_row.*"))


SQL = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), grouped AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM hashed JOIN grouped USING (text_sha256)
"""
