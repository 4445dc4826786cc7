"""Functions on H3 ids that need only the published bit layout.

bit 63 reserved 0 | 59-62 mode | 56-58 reserved | 52-55 resolution | 45-51 base cell |
fifteen 3-bit digits, most significant first, 7 = unused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .scalar import ColumnLike, col, deal, shift_left, spread

# Fixed values of the published H3 layout.
BASE_CELLS = 122
PENTAGON_BASE_CELLS = [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]
ONE_PER_DIGIT = sum(1 << (3 * i) for i in range(15))
DIGIT_BITS = (1 << 45) - 1
CELL_MODE = 1
MAX_RESOLUTION = 15

LEVELS_AT_ONCE = 5  # one row opens into 7^5 at most


def cell_resolution(cell: ColumnLike) -> Column:
    return F.shiftright(col(cell), 52).bitwiseAND(F.lit(15)).cast("int")


def cell_mode(cell: ColumnLike) -> Column:
    return F.shiftrightunsigned(col(cell), 59).bitwiseAND(F.lit(15)).cast("int")


def base_cell(cell: ColumnLike) -> Column:
    return F.shiftright(col(cell), 45).bitwiseAND(F.lit(127)).cast("int")


def cell_to_hex(cell: ColumnLike) -> Column:
    return F.lower(F.hex(col(cell)))


def hex_to_cell(text: ColumnLike) -> Column:
    """Hex text to BIGINT; null when the text is not a hexadecimal number of up to 16 digits."""
    t = col(text)
    return F.when(t.rlike("^[0-9A-Fa-f]{1,16}$"), hex_to_bigint(t))


def hex_to_bigint(t: Column) -> Column:
    """Up to 16 hex digits as a two's-complement BIGINT."""
    full = F.lpad(t, 16, "0")
    high = F.conv(F.substring(full, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(full, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def _unused_digits(resolution: Column) -> Column:
    """All ones in the digits finer than ``resolution``."""
    return shift_left(F.lit(1).cast("bigint"), F.lit(45) - resolution * 3) - F.lit(1)


def _header_and_digits_ok(cell: Column) -> Column:
    """All of the layout but for the subsequences deleted below a pentagon."""
    unused = _unused_digits(cell_resolution(cell))
    # a digit is 7 exactly when its three bits are all set
    sevens = (cell.bitwiseAND(F.shiftright(cell, 1)).bitwiseAND(F.shiftright(cell, 2))
              .bitwiseAND(F.lit(ONE_PER_DIGIT)))
    digits_ok = sevens == unused.bitwiseAND(F.lit(ONE_PER_DIGIT))
    header_ok = ((cell > 0) & (cell_mode(cell) == CELL_MODE)
                 & (F.shiftright(cell, 56).bitwiseAND(F.lit(7)) == 0) & (base_cell(cell) < BASE_CELLS))
    return header_ok & digits_ok


def _deleted(cell: Column) -> Column:
    """Whether the cell lies in the subsequence that a pentagon has lost."""
    # written in base 8 without leading zeros, the digits start with the first non-zero one
    leading = F.substring(F.conv(cell.bitwiseAND(F.lit(DIGIT_BITS)).cast("string"), 10, 8), 1, 1)
    return base_cell(cell).isin(PENTAGON_BASE_CELLS) & (leading == "1")


def h3_is_valid(cell: ColumnLike) -> Column:
    c = col(cell)
    return F.coalesce(_header_and_digits_ok(c) & ~_deleted(c), F.lit(False))


def h3_parent(cell: ColumnLike, resolution: int) -> Column:
    """Ancestor at ``resolution``; null when the cell is already coarser."""
    c = col(cell)
    cleared = c.bitwiseAND(F.lit(~(15 << 52)))
    parent = cleared.bitwiseOR(F.lit((resolution << 52) | ((1 << (45 - 3 * resolution)) - 1)))
    return F.when(cell_resolution(c) >= resolution, parent)


def h3_children(df: DataFrame, resolution: int | None = None, levels: int | None = None, cell: str = "cell",
                out: str = "child") -> DataFrame:
    """One row per descendant (7 per level, fewer below a pentagon).

    Descendants are taken at a fixed ``resolution`` or ``levels`` below each cell.
    What all descendants of a cell share is judged once, and rows are dealt out before they multiply;
    of a descendant only its number is looked at.
    """
    c, own = F.col(cell), cell_resolution(F.col(cell)).cast("int")
    target = F.lit(resolution) if levels is None else own + levels
    most = resolution if levels is None else levels
    kept = c.bitwiseAND(F.lit(~(15 << 52))).bitwiseAND(F.bitwise_not(_unused_digits(own)))
    first = (kept.bitwiseOR(shift_left(F.col("__target").cast("bigint"), F.lit(52)))
             .bitwiseOR(_unused_digits(F.col("__target"))))
    # below a pentagon itself, or its middle descendants, some descendants are missing
    middle = base_cell(kept).isin(PENTAGON_BASE_CELLS) & (kept.bitwiseAND(F.lit(DIGIT_BITS)) == 0)
    numbered = df.withColumn("__target", target).filter((F.col("__target") >= own) & (F.col("__target") <= MAX_RESOLUTION)).withColumns({
        "__first": first, "__middle": middle, "__k": F.lit(0).cast("bigint")})
    # the filling ones of the unused digits would lead where there are no others, so the middle is asked first
    numbered = numbered.filter(_header_and_digits_ok(F.col("__first")) & (F.col("__middle") | ~_deleted(F.col("__first"))))
    if most:
        numbered = deal(numbered)
    # descendants are a range of numbers, opened a few levels at a time
    for below in reversed(range(0, max(most, 1), LEVELS_AT_ONCE)):
        levels_now = F.least(F.greatest(F.col("__target") - own - below, F.lit(0)), F.lit(LEVELS_AT_ONCE))
        width = F.round(F.pow(F.lit(7.0), levels_now)).cast("bigint")
        numbered = numbered.withColumns({"__low": F.col("__k") * width, "__high": F.col("__k") * width + width - 1}).withColumn(
            "__k", F.explode(F.sequence("__low", "__high")))
        if below:
            numbered = spread(numbered, cell, "__k")
    # the child number in base 7 gives the new digits, finest last
    digits = F.lit(0).cast("bigint")
    for place in range(most):
        digit = F.pmod(F.floor(F.col("__k") / F.lit(float(7**place))), F.lit(7))
        digits = digits.bitwiseOR(F.shiftleft(digit.cast("bigint"), 3 * place))
    child = F.col("__first").bitwiseOR(shift_left(digits, F.lit(45) - F.col("__target") * 3))
    # a number leads with the digit 1 from a power of 7 up to twice that power
    missing = F.lit(False)
    for place in range(most):
        missing = missing | F.col("__k").between(7**place, 2 * 7**place - 1)
    return numbered.filter(~(F.col("__middle") & missing)).withColumn(out, child).drop(
        "__k", "__target", "__first", "__middle", "__low", "__high")
