"""Removal of word sequences that an earlier document holds, by recompression.

Recompression shrinks a sequence level by level.  A level names pairs of
neighbours (the left one of a name with coin 0, the right one with coin 1, so
pairs never overlap) and, from ``PAIR_LEVELS`` on, first runs of equal
neighbours.  A name is a hash of its parts, so every task gives the same name
to the same words, and equal stretches are cut alike but for their ends.
Runs begin above the levels that look into single windows, as a window cannot
see whether a run goes on beyond it; there equal neighbours stay apart, which
is always consistent.

Spark rounds use the names:

1. *Cores.*  What a window of ``WINDOW`` words can know of its own cutting are
   the symbols away from its ends; after ``PAIR_LEVELS`` levels there are two at
   least.  Of the names of ``CORE`` neighbours among them the smallest is the
   window's core.  Cores that occur in one document only (a count over all
   documents) cannot lie in a shared window; the others are alive.
2. *Units.*  The symbols of the highest level, in steps of ``UNIT_WORDS``, hold
   the windows.  A unit's context, from its first to its last window with a
   living core, is named by 128 bits of its words, and the first document of
   every context is found.  In every later document all its windows are
   repeats: long repeats are settled by their symbols, without their windows.
3. *Windows.*  What is left are the windows of different contexts, each taken
   from the first document of its context.  The first document of every
   window is found, and with it the windows of a context that an even earlier
   document holds.

Texts are read for each round and do not move before the last join.  Bitmaps
of names that tell a reader what to send are bounded in size; one that is
full sends more rows and changes no result.  Texts of more than ``PIECE``
words are looked at in pieces that share the windows across their border.

Defined cases: a null text has no words; a document of fewer than ``WINDOW``
words loses nothing; a repeat inside one document, or between rows of equal
``doc_id``, is none; a row without ``doc_id`` comes after all others and is
never the earlier one; rows that repeat are cut alike; an empty table gives an
empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bitmaps import bitmap_of, in_bitmap
from .shingles import BASE, BYTE_CODES, INVERSE, _Powers, mixed
from .tables import materialise, text_of

WINDOW = 13  # words
PAIR_LEVELS = 2
CORE = 3  # symbols, fewer where a window knows fewer
LEVELS = 8
UNIT_WORDS = 64  # places of a bit mask
PIECE = 1 << 17  # words of a text that are looked at together
SLICE = 1 << 20  # bytes of short texts that are looked at together
LAST = (1 << 63) - 1  # stands for no doc_id

_LEFT, _RIGHT, _RUN = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_SECOND = 0x8EBC6AF09C88C6E3 | 1
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
_up, _down = _Powers(BASE), _Powers(INVERSE)
_up2, _down2 = _Powers(_SECOND), _Powers(pow(_SECOND, -1, 1 << 64))


class Sequences:
    """Word hashes of some pieces of texts, one after the other, with the windows that start in them."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        self.words, ends = words, np.cumsum(lengths)
        self.piece = np.repeat(np.arange(len(lengths)), lengths)
        self.start = ends - lengths
        self.windows = np.flatnonzero(np.arange(len(words)) + WINDOW <= np.repeat(ends, lengths))

    def parse(self, units: bool) -> Sequences:
        """Names the levels; leaves the core of every window and, where wanted, the number of the unit of every word."""
        names, begin = self.words, np.arange(len(self.words))
        last = np.ones(len(names), bool)  # symbols at the end of their piece
        last[:-1] = self.piece[1:] != self.piece[:-1]
        lo, hi = self.windows, self.windows + WINDOW
        for level in range(1, (LEVELS if units else PAIR_LEVELS) + 1):
            if level > PAIR_LEVELS:
                names, begin, last = _runs(names, begin, last)
            coin = (names >> np.uint64(level)) & np.uint64(1) == 1
            first = np.zeros(len(names), bool)
            first[:-1] = ~coin[:-1] & coin[1:] & ~last[:-1]
            at = np.flatnonzero(first)
            paired = names.copy()
            paired[at] = mixed(names[at] * _LEFT + names[at + 1] * _RIGHT)
            ended = last.copy()
            ended[at] = last[at + 1]
            kept = np.ones(len(names), bool)
            kept[at + 1] = False
            if level <= PAIR_LEVELS:
                # a symbol at an end that might join what lies outside is not known to the window
                above = np.cumsum(kept) - 1
                lo, hi = above[lo + coin[lo]], above[hi - 1 - ~coin[hi - 1]] + 1
            names, begin, last = paired[kept], begin[kept], ended[kept]
            if level == PAIR_LEVELS:
                self._choose(names, lo, hi)
        if units:
            offset = np.arange(len(self.words)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(self.words)]))))
            self.unit = np.cumsum(offset % UNIT_WORDS == 0)
        return self

    def _choose(self, names: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        self.core = np.empty(len(lo), np.uint64)
        grams, size = names, hi - lo
        for k in range(1, CORE + 1):
            if k > 1:
                grams = mixed(grams[:-1] * _LEFT + names[k - 1:] * _RIGHT)
            which = np.flatnonzero(size == k if k < CORE else size >= k)
            if not len(which):
                continue
            at, more = lo[which], size[which] - k
            best = grams[at]
            for step in range(1, int(more.max()) + 1):
                wide = np.flatnonzero(more >= step)
                best[wide] = np.minimum(best[wide], grams[at[wide] + step])
            self.core[which] = best

    def hashes(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the words from ``lo`` to before ``hi``."""
        if not hasattr(self, "_sums"):
            n, zero = len(self.words), np.zeros(1, np.uint64)
            self._sums = (np.concatenate((zero, np.cumsum(self.words * _up.first(n)))),
                          np.concatenate((zero, np.cumsum(mixed(self.words) * _up2.first(n)))))
        size = (hi - lo).astype(np.uint64)
        one, two = self._sums
        return (mixed((one[hi] - one[lo]) * _down.first(len(one))[lo] + size),
                mixed((two[hi] - two[lo]) * _down2.first(len(two))[lo] + size))


def _runs(names: np.ndarray, begin: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of equal neighbours under one name each."""
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | last[:-1]
    first = np.flatnonzero(new)
    if len(first) == len(names):
        return names, begin, last
    length = np.diff(np.concatenate((first, [len(names)])))
    named = names[first]
    long = length > 1
    named[long] = mixed(named[long] * _RUN + length[long].astype(np.uint64))
    return named, begin[first], last[first + length - 1]


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as they are; ``bytes.split`` knows exactly the ASCII blanks."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; none goes beyond a break."""
    solid = ~_BLANK[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inside = breaks[(breaks > 0) & (breaks < len(data))]
    begins[inside] = solid[inside]
    ends[inside - 1] = solid[inside - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hashes of words, which do not depend on their place; the same as ``word_hashes``."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[data] * _up.first(len(data)))))
    return mixed((sums[end] - sums[start]) * _down.first(len(data) + 1)[start] + (end - start).astype(np.uint64))


def _read(batches: Iterator[pa.RecordBatch], units: bool) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch, Sequences]]:
    """Some texts at a time: the row and the first word of every piece, the batch, and the pieces, parsed."""
    for batch in batches:
        column = batch["text"].cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        if not len(column) or offsets[-1] == offsets[0]:
            continue
        data = np.frombuffer(column.buffers()[2], np.uint8)
        row = 0
        while row < len(column):
            # as many whole texts as fit, one at least
            upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
            part = data[offsets[row]:offsets[upto]]
            edges = offsets[row:upto + 1] - offsets[row]
            start, end = _words(part, edges)
            counts = np.diff(np.searchsorted(start, edges))
            if upto - row > 1 or len(start) <= PIECE + WINDOW:
                wide = counts >= WINDOW
                if wide.any():
                    yield np.flatnonzero(wide) + row, np.zeros(wide.sum(), np.int64), batch, Sequences(
                        _hashed(part, start, end)[np.repeat(wide, counts)], counts[wide]).parse(units)
            else:
                for at in range(0, len(start) - WINDOW + 1, PIECE):
                    some = slice(at, at + PIECE + WINDOW - 1)
                    low, high = start[some][0], end[some][-1]
                    words = _hashed(part[low:high], start[some] - low, end[some] - low)
                    yield np.array([row]), np.array([at]), batch, Sequences(words, np.array([len(words)])).parse(units)
            row = upto


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, doc), neighbouring windows with the same core once."""
    for row, _, batch, seq in _read(batches, units=False):
        doc = np.asarray(batch["doc"])[row][seq.piece[seq.windows]]
        new = np.ones(len(doc), bool)
        new[1:] = (seq.core[1:] != seq.core[:-1]) | (doc[1:] != doc[:-1])
        yield _table(hash=_signed(seq.core[new]), doc=doc[new])


def _units(seq: Sequences, alive: tuple[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first and last window of every unit's context, and all windows with a living core."""
    live = seq.windows[in_bitmap(np.frombuffer(alive[0], np.uint8), alive[1], seq.core)]
    if not len(live):
        return live, live, live
    first = np.flatnonzero(np.concatenate(([True], np.diff(seq.unit[live]) != 0)))
    return live[first], live[np.concatenate((first[1:], [len(live)])) - 1], live


def _contexts(alive: tuple[bytes, int]):
    def rows_of(batches):
        for row, base, batch, seq in _read(batches, units=True):
            lo, hi, _ = _units(seq, alive)
            one, two = seq.hashes(lo, hi + WINDOW)
            piece = seq.piece[lo]
            yield _table(key=batch["key"].take(pa.array(row[piece])), doc=np.asarray(batch["doc"])[row[piece]], start=base[piece] + lo - seq.start[piece],
                         windows=(hi - lo + 1).astype(np.int32), one=_signed(one), two=_signed(two))

    return rows_of


def _mark(one, doc):
    """Tells the occurrences of a context in different documents apart by its leading bits."""
    return one ^ (doc << 40)


def _windows(alive: tuple[bytes, int], marks: tuple[bytes, int], wanted: tuple[bytes, int] | None = None):
    """The living windows of the marked contexts; with ``wanted``, those among them, with their context and place in it."""
    def rows_of(batches):
        for row, _, batch, seq in _read(batches, units=True):
            lo, hi, live = _units(seq, alive)
            one, _ = seq.hashes(lo, hi + WINDOW)
            doc = np.asarray(batch["doc"])[row]
            marked = in_bitmap(np.frombuffer(marks[0], np.uint8), marks[1], _mark(_signed(one), doc[seq.piece[lo]]).view(np.uint64))
            unit = np.searchsorted(lo, live, "right") - 1
            live, unit = live[marked[unit]], unit[marked[unit]]
            first, second = seq.hashes(live, live + WINDOW)
            second = (second >> np.uint64(32)).astype(np.uint32).view(np.int32)
            if wanted is None:
                yield _table(w1=_signed(first), w2=second, doc=doc[seq.piece[live]])
                continue
            hit = in_bitmap(np.frombuffer(wanted[0], np.uint8), wanted[1], first)
            live, unit = live[hit], unit[hit]
            yield _table(w1=_signed(first[hit]), w2=second[hit], doc=doc[seq.piece[live]], one=_signed(one[unit]), place=(live - lo[unit]).astype(np.int32))

    return rows_of


def _row_key() -> Column:
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), text_of())))


def repeats(docs: DataFrame) -> DataFrame:
    """key (of a row's id and text) and parts: (start, windows, mask) of stretches of windows, of which those in the mask are repeats."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    texts = docs.select(doc, text_of().alias("text"))
    keyed = docs.select(_row_key().alias("key"), doc, text_of().alias("text"))
    shared = (F.min("doc") < F.max("doc")).alias("shared")

    cores = texts.mapInArrow(_cores, "hash long, doc long").groupBy("hash").agg(shared).filter("shared").select("hash")
    alive = bitmap_of(materialise(cores, "cores"))
    contexts = materialise(keyed.mapInArrow(_contexts(alive), "key binary, doc long, start long, windows int, one long, two long"), "contexts")
    firsts = materialise(contexts.groupBy("one", "two").agg(F.min("doc").alias("first")), "firsts")

    marks = bitmap_of(firsts.select(F.col("one").bitwiseXOR(F.shiftleft("first", 40)).alias("hash")))
    windows = texts.mapInArrow(_windows(alive, marks), "w1 long, w2 int, doc long").groupBy("w1", "w2").agg(F.min("doc").alias("earliest"), shared)
    twice = materialise(windows.filter("shared").select("w1", "w2", "earliest"), "windows")
    wanted = bitmap_of(twice.select(F.col("w1").alias("hash")))
    placed = texts.mapInArrow(_windows(alive, marks, wanted), "w1 long, w2 int, doc long, one long, place int")
    masks = placed.join(twice, ["w1", "w2"]).filter("doc > earliest").groupBy("one", F.col("doc").alias("first")).agg(
        F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask"))

    known = firsts.join(masks, ["one", "first"], "left")
    later = F.col("doc") > F.col("first")
    mask = F.when(later, F.lit(-1).cast("long")).otherwise(F.coalesce("mask", F.lit(0).cast("long")))
    hits = contexts.join(known, ["one", "two"]).withColumn("_mask", mask).filter("_mask != 0")
    parts = hits.groupBy("key").agg(F.collect_set(F.struct("start", "windows", F.col("_mask").alias("mask"))).alias("parts"))
    return materialise(parts, "parts")


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, text, parts in zip(batch["doc_id"], batch["text"], batch["parts"], strict=True):
            words = words_of(text)
            edges = np.zeros(len(words) + 1, np.int64)
            for part in (() if parts is None else parts):
                bits = np.arange(part["windows"])
                at = part["start"] + bits[(part["mask"] >> bits) & 1 == 1]
                np.add.at(edges, at, 1)
                np.add.at(edges, at + WINDOW, -1)
            gone = np.cumsum(edges[:-1]) > 0
            change = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
            kept = b" ".join(words if not gone.any() else [w for w, g in zip(words, gone.tolist(), strict=True) if not g])
            out.append((doc_id, len(words), change.reshape(-1, 2).tolist(), kept.decode("utf-8", "surrogatepass")))
        yield pd.DataFrame(out, columns=["doc_id", "n_words", "removed", "kept"])


def cut(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, removed (the removed runs, first word and the one after the last) and kept, the other words, of every row."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text"), _row_key().alias("key"))
    joined = rows.join(repeats(docs), "key", "left").select("doc_id", "text", "parts")
    out = joined.mapInPandas(_cut, "doc_id string, n_words long, removed array<array<long>>, kept string")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    return cut(docs).select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
