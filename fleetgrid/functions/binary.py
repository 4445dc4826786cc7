"""Big-endian integers and IEEE-754 numbers in binary columns, both ways."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .bits import hex_to_bigint
from .hashing import signed32
from .scalar import ColumnLike, col, dbl, let


def _slice(data: Column, start: Column | int, length: Column | int) -> Column:
    as_col = lambda v: F.lit(v) if isinstance(v, int) else v
    return data.substr(as_col(start).cast("int"), as_col(length).cast("int"))


def get_i64(data: ColumnLike, start: Column | int) -> Column:
    return hex_to_bigint(F.hex(_slice(col(data), start, 8)))


def get_u32(data: ColumnLike, start: Column | int) -> Column:
    return F.conv(F.hex(_slice(col(data), start, 4)), 16, 10).cast("bigint")


def get_i32(data: ColumnLike, start: Column | int) -> Column:
    return signed32(get_u32(data, start))


def get_text(data: ColumnLike, start: Column | int, length: Column | int) -> Column:
    return F.decode(_slice(col(data), start, length), "UTF-8")


def _ieee_value(bits: Column, exponent_bits: int, fraction_bits: int) -> Column:
    bias = (1 << (exponent_bits - 1)) - 1
    top = (1 << exponent_bits) - 1
    scale = dbl(2.0**fraction_bits)

    def read(b: Column) -> Column:
        negative = F.shiftrightunsigned(b, exponent_bits + fraction_bits).bitwiseAND(F.lit(1)) == 1
        exponent = F.shiftrightunsigned(b, fraction_bits).bitwiseAND(F.lit(top)).cast("int")
        fraction = b.bitwiseAND(F.lit((1 << fraction_bits) - 1).cast("bigint")).cast("double") / scale
        special = F.when(fraction == 0.0, dbl(float("inf"))).otherwise(dbl(float("nan")))
        tiny = fraction * F.pow(dbl(2.0), F.lit(1 - bias))
        normal = (dbl(1.0) + fraction) * F.pow(dbl(2.0), exponent - bias)
        size = F.when(exponent == top, special).when(exponent == 0, tiny).otherwise(normal)
        return F.when(negative, -size).otherwise(size)

    return let(bits, read)


def get_f64(data: ColumnLike, start: Column | int) -> Column:
    return _ieee_value(get_i64(data, start), 11, 52)


def get_f32(data: ColumnLike, start: Column | int) -> Column:
    return _ieee_value(get_i32(data, start).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")), 8, 23)


def _ieee_bits(value: Column, exponent_bits: int, fraction_bits: int) -> Column:
    bias = (1 << (exponent_bits - 1)) - 1
    top = (1 << exponent_bits) - 1
    scale = dbl(2.0**fraction_bits)

    def write(v: Column) -> Column:
        size = F.abs(v)
        sign = F.when(F.startswith(v.cast("string"), F.lit("-")), F.lit(1)).otherwise(F.lit(0)).cast("bigint")

        def with_exponent(guess: Column) -> Column:
            # log2 may be off by one next to a power of two
            exact = (F.when(F.pow(dbl(2.0), guess) > size, guess - 1)
                     .when(F.pow(dbl(2.0), guess + 1) <= size, guess + 1).otherwise(guess))

            def assemble(e: Column) -> Column:
                fraction = ((size / F.pow(dbl(2.0), e) - dbl(1.0)) * scale).cast("bigint")
                return F.shiftleft((e + bias).cast("bigint"), fraction_bits).bitwiseOR(fraction)

            return let(exact, assemble)

        tiny_steps = size * F.pow(dbl(2.0), F.lit(bias - 1)) * scale
        smallest = dbl(2.0 ** (1 - bias))
        body = (F.when(F.isnan(v), F.lit((top << fraction_bits) | (1 << (fraction_bits - 1))).cast("bigint"))
                .when(size == dbl(float("inf")), F.lit(top << fraction_bits).cast("bigint"))
                .when(size < smallest, tiny_steps.cast("bigint"))
                .otherwise(let(F.floor(F.log2(size)).cast("int"), with_exponent)))
        return F.shiftleft(sign, exponent_bits + fraction_bits).bitwiseOR(body)

    return let(value.cast("double"), write)


def double_bits(value: ColumnLike) -> Column:
    """The IEEE-754 bits of a double as a signed whole number."""
    return _ieee_bits(col(value), 11, 52)


def put_i64(value: ColumnLike) -> Column:
    return F.unhex(F.lpad(F.hex(col(value).cast("bigint")), 16, "0"))


def put_i32(value: ColumnLike) -> Column:
    low = col(value).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    return F.unhex(F.lpad(F.hex(low), 8, "0"))


def put_f64(value: ColumnLike) -> Column:
    return put_i64(_ieee_bits(col(value), 11, 52))


def put_f32(value: ColumnLike) -> Column:
    return put_i32(_ieee_bits(col(value).cast("float").cast("double"), 8, 23))


def put_text(value: ColumnLike) -> Column:
    """UTF-8 bytes behind their 32-bit length."""
    data = F.encode(col(value), "UTF-8")
    return F.concat(put_i32(F.octet_length(data)), data)
