"""Hashes whose values must agree with those of other systems, on native columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalar import ColumnLike, col, let

# Fixed values of the published hash algorithms.
MASK32 = 0xFFFFFFFF
MURMUR2_SEED = 0x9747B28C
MURMUR2_MULTIPLIER = 0x5BD1E995
FINALISER_FIRST = 0xFF51AFD7ED558CCD
FINALISER_SECOND = 0xC4CEB9FE1A85EC53


def _big(value: int) -> Column:
    return F.lit(value).cast("bigint")


def signed32(v: Column) -> Column:
    """Read the low 32 bits as a signed number (as BIGINT: a cast to INT would raise)."""
    sign = _big(1 << 31)
    return v.bitwiseAND(_big(MASK32)).bitwiseXOR(sign) - sign


def fold32(cell: ColumnLike) -> Column:
    """A 64-bit id folded to a signed 32-bit hash: high half xor low half."""
    c = col(cell)
    return signed32(c.bitwiseXOR(F.shiftrightunsigned(c, 32)))


def java_hash(text: ColumnLike) -> Column:
    """The 31-polynomial string hash over UTF-16 units, unsigned in [0, 2^32)."""

    def step(acc: Column, ch: Column) -> Column:
        point = F.ascii(ch).cast("bigint")
        high = F.lit(0xD800) + F.shiftright(point - 0x10000, 10)
        low = F.lit(0xDC00) + (point - 0x10000).bitwiseAND(F.lit(0x3FF))
        single = acc * 31 + point
        pair = (acc * 31 + high) * 31 + low
        return F.when(point > 0xFFFF, pair).otherwise(single).bitwiseAND(_big(MASK32))

    # splitting "" gives one empty letter, which must not be counted
    letters = lambda t: F.filter(F.split(t, ""), lambda ch: ch != "")
    return F.aggregate(letters(col(text)), _big(0), step)


def byte_at(hexed: Column, index: Column) -> Column:
    """Unsigned byte ``index`` (from 0) of hex text."""
    return F.conv(hexed.substr(index.cast("int") * 2 + 1, F.lit(2)), 16, 10).cast("bigint")


def bytes_hash(data: ColumnLike) -> Column:
    """The 31-polynomial hash over signed bytes starting from 1, unsigned in [0, 2^32)."""
    hexed = F.hex(col(data))
    count = F.octet_length(col(data))

    def step(acc: Column, i: Column) -> Column:
        b = byte_at(hexed, i)
        signed = F.when(b > 127, b - 256).otherwise(b)
        return (acc * 31 + signed).bitwiseAND(_big(MASK32))

    indices = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(indices, _big(1), step)


def murmur2(data: ColumnLike) -> Column:
    """32-bit MurmurHash2 over binary data, unsigned in [0, 2^32)."""
    hexed = F.hex(col(data))
    count = F.octet_length(col(data))
    mult = _big(MURMUR2_MULTIPLIER)
    mask = _big(MASK32)

    def scramble(v: Column) -> Column:
        return (v * mult).bitwiseAND(mask)

    def word(i: Column) -> Column:
        parts = [hexed.substr(i.cast("int") * 8 + 1 + 2 * b, F.lit(2)) for b in (3, 2, 1, 0)]
        return F.conv(F.concat(*parts), 16, 10).cast("bigint")

    def mix(acc: Column, i: Column) -> Column:
        k = let(scramble(word(i)), lambda v: scramble(v.bitwiseXOR(F.shiftright(v, 24))))
        return scramble(acc).bitwiseXOR(k)

    whole = F.floor(count / 4).cast("int")
    indices = F.when(whole > 0, F.sequence(F.lit(0), whole - 1)).otherwise(F.array().cast("array<int>"))
    start = count.cast("bigint").bitwiseXOR(_big(MURMUR2_SEED))

    def tail(h: Column) -> Column:
        left, base = count % 4, whole * 4
        t = h
        for position, shift in ((2, 16), (1, 8), (0, 0)):
            value = F.when(left > position, F.shiftleft(byte_at(hexed, base + position), shift)).otherwise(_big(0))
            t = t.bitwiseXOR(value)
        return F.when(left > 0, scramble(t)).otherwise(h)

    mixed = let(F.aggregate(indices, start, mix), tail)
    finished = let(mixed, lambda h: scramble(h.bitwiseXOR(F.shiftright(h, 13))))
    return let(finished, lambda h: h.bitwiseXOR(F.shiftright(h, 15)))


def _wrapping_multiply(v: Column, constant: int) -> Column:
    """Low 64 bits of a product from 16-bit limbs, which never overflow a BIGINT."""
    a = [F.shiftrightunsigned(v, 16 * i).bitwiseAND(_big(0xFFFF)) for i in range(4)]
    b = [(constant >> (16 * i)) & 0xFFFF for i in range(4)]
    result, carry = None, _big(0)
    for place in range(4):
        total = carry
        for i in range(place + 1):
            total = total + a[i] * _big(b[place - i])
        limb = F.shiftleft(total.bitwiseAND(_big(0xFFFF)), 16 * place)
        result = limb if result is None else result.bitwiseOR(limb)
        carry = F.shiftright(total, 16)
    return result


def seed_of(entity: ColumnLike, scenario: ColumnLike) -> Column:
    """A reproducible 64-bit seed: string hash of ``entity:scenario`` through the murmur finaliser."""
    text = F.concat(col(entity), F.lit(":"), col(scenario))
    start = signed32(java_hash(text) + _big(31))

    def fold(v: Column) -> Column:
        return v.bitwiseXOR(F.shiftrightunsigned(v, 33))

    first = let(start, fold)
    second = let(let(first, lambda v: _wrapping_multiply(v, FINALISER_FIRST)), fold)
    return let(let(second, lambda v: _wrapping_multiply(v, FINALISER_SECOND)), fold)
