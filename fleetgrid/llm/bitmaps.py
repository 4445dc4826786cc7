"""A bitmap of 64-bit hashes, bounded in size, that tells which hashes need not be looked at."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

MOST_BITS = 28  # 32 MB at most, however many hashes there are
BITS_PER_HASH = 16
BLOCK_BYTES = 4096  # of Spark's bitmap functions


def bitmap_of(hashes: DataFrame, column: str = "hash", most: int = MOST_BITS) -> tuple[bytes, int]:
    """A bitmap over the leading bits of the distinct hashes, and by how many bits they are shifted.

    A bitmap that is too small for its hashes lets more of the others through; it
    never loses one.
    """
    n = max(1, hashes.count())
    bits = min(most, max(16, (BITS_PER_HASH * n - 1).bit_length()))
    leading = F.shiftrightunsigned(column, 64 - bits)
    blocks = hashes.select(F.shiftright(leading, 15).alias("block"), leading.bitwiseAND(F.lit(32_767)).alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bitmap"))
    held = np.zeros((1 << bits) // 8, np.uint8)
    for block, bitmap in blocks.collect():
        at = block * BLOCK_BYTES
        held[at:at + BLOCK_BYTES] = np.frombuffer(bitmap, np.uint8)[:len(held) - at]
    return held.tobytes(), 64 - bits


def in_bitmap(bitmap: np.ndarray, shift: int, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(shift)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
