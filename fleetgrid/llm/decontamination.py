"""Benchmark decontamination by template windows.

Texts become token sequences in which numbers and units are typed
placeholders.  Two forms of every window of five tokens are hashed: the plain
form, with words in lower case, and the template form, in which capitalised
words are a placeholder as well.  A window with a name and fewer than three
plain words is widened for its template form until it holds three: to the
right, or to the left where the item ends first.  Windows of documents meet
windows of benchmark items in a hash join.  Windows that agree at the same shift are one
alignment; the values that its placeholders stand for must map one item value
to one document value, or the alignment is a coincidence.  A document leaks an
item when consistent alignments cover at least 80 % of the item's windows, be
it word for word or with other numbers and names.  Documents and items first meet
by the rarest windows of an item, one of which every leak must hold; a window
that many items share brings none of them together.

Before the join a bitmap of the benchmark's window hashes drops the document
windows that cannot match.  Its size is bounded; when a larger benchmark fills
it, more windows reach the join and nothing is lost.

Defined cases: null or empty texts leak nothing; an item of fewer than five
tokens is one window, found anywhere in a document, and found word for word only
when fewer than three of its tokens are fixed; an item with fewer than three plain
words has no template form; repeated items and rows give repeated pairs once;
rows with equal or no doc_id or item_id are compared each by itself and named by
that id; very long texts are read whole;
empty tables give an empty result; other columns are never looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh3_64_intdigest

from .bitmaps import bitmap_of, in_bitmap
from .tables import materialise, text_of

WINDOW = 5
COVERAGE = 0.8
LITERALS = 3  # a template window holds at least so many plain words
TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,:/]\d+)*")
ASCII_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+(?:[.,:/][0-9]+)*")  # the same for texts without other characters
KEPT_CODES = 500_000
RUN_CHARS = 1 << 18  # characters of neighbouring texts whose windows are worked out together
MOST_SENT = 16 << 20  # bytes of item windows, as rows, up to which they travel to every task

# Words that are units after a number, and words that are numbers.
UNITS = frozenset(
    "mm cm m km in inch inches ft feet foot yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ton tons "
    "ml l liter liters litre litres s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "mph kmh dollar dollars cent cents euro euros usd eur percent degree degrees".split())
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split())

WORD, NAME, NUMBER, UNIT = range(4)  # kinds, kept in the low bits of a token's code
KIND_BITS = np.uint64(7)
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
INVERSE = np.uint64(pow(int(ODD[0]), -1, 2**64))
TO_RIGHT, TO_LEFT = np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3)  # tell the two ways of widening apart
NAMED, NUMBERED, MEASURED = (np.uint64(x * 0x9E3779B97F4A7C15 % 2**64 & ~7) for x in (1, 2, 3))


SPECIAL = dict.fromkeys(UNITS, UNIT) | dict.fromkeys(NUMBER_WORDS, NUMBER)


def literal_code(token: str) -> int:
    """A stable 64-bit code of the lower-cased token itself, a number or not."""
    return xxh3_64_intdigest(token.lower().encode("utf-8", "surrogatepass")) & ~7


def code_of(token: str) -> int:
    """A stable 64-bit code of the lower-cased token, one for all numbers, with its kind in the low bits."""
    lower = token.lower()
    kind = SPECIAL.get(lower)
    if kind == NUMBER or token[0].isdigit():
        return int(NUMBERED) | NUMBER
    if kind is None:
        kind = NAME if token[0].isupper() else WORD
    return xxh3_64_intdigest(lower.encode("utf-8", "surrogatepass")) & ~7 | kind


class Codes(dict):
    """Codes of tokens seen so far."""

    def __missing__(self, token):
        self[token] = code = code_of(token)
        return code


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * ODD[1]
    return h ^ (h >> np.uint64(29))


def range_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray, salt: np.uint64) -> np.ndarray:
    """Hashes of the ranges [start, end) of codes; equal ranges hash alike wherever they begin."""
    base, inverse = np.full(len(codes) + 1, ODD[0]), np.full(len(codes) + 1, INVERSE)
    base[0] = inverse[0] = 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * np.cumprod(base)[:-1])))
    return mixed((sums[end] - sums[start]) * np.cumprod(inverse)[start] ^ salt) | np.uint64(1)


class Windows:
    """Tokens of some texts in a row, and the forms of their windows: (place, start, end, hash) arrays and whether names are placeholders.

    Places, starts and ends count from the first token of all; no window crosses
    the end of a text.
    """

    def __init__(self, tokens: list[str], first: np.ndarray, last: np.ndarray, owner: np.ndarray, forms: list[tuple]):
        self.tokens, self.first, self.last, self.owner, self.forms = tokens, first, last, owner, forms

    def total(self, text: int) -> int:
        """Windows of a text; one that is shorter than a window is one."""
        return max(1, int(self.last[text] - self.first[text]) - WINDOW + 1)


def windows_of(texts: list[str], codes: Codes, short: tuple[int, ...] | None = None, widest: int | None = None) -> Windows:
    """The windows of some texts, worked out together.

    A text of fewer tokens than ``WINDOW`` is one window.  With ``short`` the
    windows of these widths are added instead, and of the widened windows only
    those of at most ``widest`` tokens are made.
    """
    found: list[str] = []
    last = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found += (ASCII_TOKEN if text.isascii() else TOKEN).findall(text)
        last[i] = len(found)
    first = np.concatenate((np.zeros(1, np.int64), last[:-1]))
    size = len(found)
    owner = np.repeat(np.arange(len(texts)), last - first)  # the text of each token
    if not found:
        return Windows(found, first, last, owner, [])
    if len(codes) > KEPT_CODES:
        codes.clear()
    code = np.fromiter(map(codes.__getitem__, found), np.uint64, size)
    kind = (code & KIND_BITS).astype(np.int8)
    plain = code & ~KIND_BITS
    begin, end_of = first[owner], last[owner]
    name, number = kind == NAME, kind == NUMBER
    unit = kind == UNIT
    unit[1:] &= number[:-1]
    unit[begin == np.arange(size)] = False
    plain[unit] = MEASURED
    template = np.where(name, NAMED, plain)
    names = np.concatenate(([0], np.cumsum(name)))
    words = np.concatenate(([0], np.cumsum(~(name | number | unit))))  # plain words before each token
    forms = []
    if short is None:
        lengths = np.unique(np.minimum(last - first, WINDOW))
        widths = [int(w) for w in lengths if w]
    else:
        widths = [WINDOW, *short]
    for width in widths:
        if width > size:
            continue
        n = size - width + 1
        fits = np.arange(n) + width <= end_of[:n]
        if short is None and width < WINDOW:
            fits &= end_of[:n] - begin[:n] == width
        place = np.flatnonzero(fits)
        if not len(place):
            continue
        p = mixed(sum(plain[i:i + n] * ODD[i] for i in range(width)))
        if width < WINDOW and (number.any() or unit.any()):
            # so short a window with few fixed words agrees word for word or not at all
            slots = np.concatenate(([0], np.cumsum(number | unit)))
            few = width - (slots[width:] - slots[:n]) < LITERALS
            literal = plain.copy()
            literal[number | unit] = [literal_code(found[i]) for i in np.flatnonzero(number | unit)]
            p[few] = mixed(sum(literal[i:i + n] * ODD[i] for i in range(width)))[few]
        forms.append((place, place, place + width, p[place], False))
        held, rich = fits & (names[width:] > names[:n]), words[width:] - words[:n] >= LITERALS
        good = np.flatnonzero(held & rich)
        if len(good):
            t = mixed(sum(template[good + i] * ODD[i] for i in range(width))) | np.uint64(1)
            forms.append((good, good, good + width, t, True))
        poor = np.flatnonzero(held & ~rich) if width == WINDOW and widest != 0 else good[:0]
        if not len(poor):
            continue
        # to the right until it holds enough words, at the end of an item to the left; a document cannot know where items end
        right = np.searchsorted(words, words[poor] + LITERALS)
        left = np.searchsorted(words, words[poor + width] - LITERALS, "right") - 1
        inside, behind = right <= end_of[poor], left >= begin[poor]
        for ok, start, end, salt in ((inside, poor, right, TO_RIGHT), (behind if short is not None else ~inside & behind, left, poor + width, TO_LEFT)):
            if widest is not None:
                ok = ok & (end - start <= widest)
            if ok.any():
                start, end = start[ok], end[ok]
                forms.append((poor[ok], start, end, range_hashes(template, start, end, salt), True))
    return Windows(found, first, last, owner, forms)


def runs_of_texts(texts: list[str]):
    """Ranges of neighbouring texts of about ``RUN_CHARS`` characters, a longer text by itself."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > RUN_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def slots_of(tokens: list[str], first: int, start: int, end: int, codes: Codes, template: bool) -> list[str]:
    """The typed values of a window of the text whose tokens begin at ``first``, in order."""
    out, number = [], start > first and codes[tokens[start - 1]] & 7 == NUMBER
    for token in tokens[start:end]:
        kind = codes[token] & 7
        if kind == NUMBER or kind == UNIT and number or kind == NAME and template:
            out.append(f"{kind}:{token.lower()}")
        number = kind == NUMBER
    return out


SCHEMA = "key string, id long, hash long, place int, width int, total int, slots array<string>"


def row_key(number: str, text: str = "text") -> Column:
    """Names a row by its id and its text: rows with equal or no ids stay apart."""
    return F.md5(F.concat(F.coalesce(F.col(number).cast("string"), F.lit("-")), F.lit(":"), text_of(text)))


def named_texts(df: DataFrame, number: str) -> DataFrame:
    return df.select(row_key(number).alias("key"), F.col(number).cast("long").alias("id"), text_of().alias("text"))


def window_rows(texts: DataFrame, bitmap: bytes | None = None, shift: int = 0, short: tuple[int, ...] | None = None, widest: int | None = None) -> DataFrame:
    """One row per form of every window of every (key, id, text); with a bitmap only those whose hash it holds."""

    def rows(batches):
        codes = Codes()
        bits = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            keys, numbers, read = batch["key"].tolist(), batch["id"].tolist(), batch["text"].tolist()
            out = []
            for low, high in runs_of_texts(read):
                made = windows_of(read[low:high], codes, short, widest)
                for place, start, end, hashes, form in made.forms:
                    at = np.arange(len(hashes)) if bits is None else np.flatnonzero(in_bitmap(bits, shift, hashes))
                    text = made.owner[place[at]]
                    first = made.first[text]
                    out += [(keys[low + x], numbers[low + x], h, i - f, e - s, made.total(x), slots_of(made.tokens, f, s, e, codes, form)) for x, f, i, s, e, h in zip(
                        text.tolist(), first.tolist(), place[at].tolist(), start[at].tolist(), end[at].tolist(), hashes[at].view(np.int64).tolist(), strict=True)]
            yield pd.DataFrame(out, columns=["key", "id", "hash", "place", "width", "total", "slots"]).astype({"id": "Int64"})

    return texts.mapInPandas(rows, SCHEMA)


def rare_places(items: DataFrame, coverage: float, way: str) -> DataFrame:
    """(item, hash) of so many of an item's rarest windows that a document with enough of its windows has one of these.

    Of n windows a leak holds at least ``ceil(coverage * n)``, so any
    ``n - ceil(coverage * n) + 1`` of them hold one that it has.  ``way`` is the
    hint for the join of the benchmark's windows.
    """
    uses = items.groupBy("hash").agg(F.count_distinct("key").alias("uses"))
    known = items.join(uses.hint(way), "hash")
    places = known.groupBy("key", "total", "place").agg(F.max("uses").alias("uses"), F.collect_set("hash").alias("hashes"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("uses", "place"))
    needed = F.col("total") - F.ceil(F.lit(coverage) * F.col("total") - 1e-9) + 1
    return places.withColumn("rank", rank).filter(F.col("rank") <= needed).select(F.col("key").alias("item"), F.explode("hashes").alias("hash")).distinct()


def _leaking(docs: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    """doc (a row's key), doc_id, item_id, windows, matched and same of every row that leaks an item."""
    items = materialise(window_rows(named_texts(benchmark, "item_id")), "items")
    bitmap, shift = bitmap_of(items.select("hash").distinct())
    # at most WINDOW - 1 short widths, the widest window of all items, and the bytes of their rows, which the compressed files do not tell
    seen = items.agg(
        F.collect_set(F.when(F.col("width") < WINDOW, F.col("width"))).alias("short"), F.max(F.when(F.col("width") > WINDOW, F.col("width"))).alias("widest"),
        F.sum(F.octet_length(F.array_join("slots", " " * 16)) + 128).alias("bytes")).first()
    # the planner would judge both tables by their files, a small part of what they are in memory; what grows with the documents never travels
    way = "broadcast" if (seen.bytes or 0) <= MOST_SENT else "merge"
    # what only the bitmap let through goes before anything is written
    found = window_rows(named_texts(docs, "doc_id"), bitmap, shift, tuple(sorted(seen.short)), seen.widest or 0)
    hits = materialise(found.join(items.select("hash").distinct().hint(way), "hash", "left_semi"), "hits")
    # a window that many items have fetches none of them
    fetched = hits.select(F.col("key").alias("doc"), "hash").distinct().join(rare_places(items, coverage, way).hint(way), "hash").select("doc", "item").distinct()
    d, i, c = hits.hint("merge").alias("d"), items.hint(way).alias("i"), fetched.alias("c")
    met = c.join(d, F.col("c.doc") == F.col("d.key")).join(i, (F.col("c.item") == F.col("i.key")) & (F.col("d.hash") == F.col("i.hash"))).select(
        "c.doc", "c.item", F.col("d.id").alias("doc_id"), F.col("i.id").alias("item_id"), F.col("i.place").alias("place"), F.col("i.total").alias("windows"),
        (F.col("d.place") - F.col("i.place")).alias("shift"),
        F.zip_with("i.slots", "d.slots", lambda a, b: F.struct(a.alias("item"), b.alias("doc"))).alias("slots"))
    # an alignment holds at most the windows of one item
    pair = ["doc", "item", "doc_id", "item_id", "windows"]
    aligned = met.groupBy(*pair, "shift").agg(F.collect_set("place").alias("places"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"))
    consistent = F.size("slots") == F.size(F.array_distinct("slots.item"))
    changed = F.exists("slots", lambda s: ~s["item"].eqNullSafe(s["doc"]))
    covered = aligned.filter(consistent).select(*pair, F.explode("places").alias("place"), changed.alias("changed"))
    pairs = covered.groupBy(*pair).agg(
        F.count_distinct("place").alias("matched"), F.count_distinct(F.when(~F.col("changed"), F.col("place"))).alias("same"))
    return pairs.filter(F.col("matched") >= F.lit(coverage) * F.col("windows"))


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, windows, matched and reparameterised for every document that leaks an item."""
    return _leaking(docs, benchmark, coverage).select(
        "doc_id", "item_id", F.col("windows").cast("long").alias("windows"), "matched",
        (F.col("same") < F.lit(coverage) * F.col("windows")).alias("reparameterised"))


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, unchanged; rows with equal or no doc_id are judged each by its text."""
    bad = materialise(_leaking(docs, benchmark, COVERAGE).select(F.col("doc").alias("__leaking")).distinct(), "leaking")
    return docs.join(bad, row_key("doc_id") == F.col("__leaking"), "left_anti")
