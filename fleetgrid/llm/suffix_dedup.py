"""Removal of byte strings of 200 bytes or more that occur more than once.

A sparse suffix array does the search.  Every 200-byte window names one of its
64-byte grams as its anchor, by the smallest hash; equal windows name equal
grams at the same place.  A window has 68 bytes or more on one side of its
anchor, so an anchor matters only if the 132 bytes that end or that start with
it occur at another anchor as well; a count of their hashes drops the others.
What is left is shuffled by gram with the bytes around it, equal surroundings
counted once.  A task sorts what starts at the anchors, and, read backwards,
what ends there, by deep-shallow sorting.  With the common prefixes of both
orders, two windows are equal when they agree on the bytes before their anchor
and on those from it on, so equality is decided on bytes, not on hashes.

Texts are read three times and do not move before the last join: for the halves
around their anchors, for the names of what surrounds repeated halves, and for the bytes of one
representative row of each name.  Surroundings that occur twice are repeated as a whole; only
different ones of one gram are sent and compared.  Names have 96 bits.  The bitmaps that the readings use are bounded;
see ``bitmaps``.  A gram with more than ``HOT_CONTEXTS`` different
surroundings, such as the end of a passage that a third of all documents
share, is not sorted in one task: its windows are counted one by one in a
distributed aggregate, with the same result.

Defined cases: null text is empty; texts shorter than 200 bytes lose nothing;
rows with equal text count as separate occurrences; repeated or null doc_ids
are rows like others; an empty table gives an empty result; other columns are
never looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from . import deep_shallow
from .bitmaps import bitmap_of, in_bitmap
from .shingles import BASE, BYTE_CODES, INVERSE, _Powers, mixed
from .tables import materialise, text_of

MATCH = 200  # bytes
GRAM = 64
SPAN = MATCH - GRAM + 1  # grams in a window
SIDE = (MATCH - GRAM) // 2  # bytes that any window has before or behind its anchor
HALF = GRAM + SIDE
PLACE_BITS = 24
PIECE = 1 << 22  # bytes of a text that are looked at together
HOT_CONTEXTS = 50_000
SENT_ROWS = 20_000  # that a task holds before it sends them
SEEN_NAMES = 200_000  # that a task remembers, so as to send the context of a common name once
SORTED_ROWS = 20_000  # rows that are sorted together, more where one gram has more

_up, _down = _Powers(BASE), _Powers(INVERSE)


def _anchors(data: np.ndarray):
    n = len(data) - MATCH + 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[data] * _up.first(len(data)))))
    down = _down.first(len(data))
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[:len(data) - GRAM + 1])
    mask = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    rows = -(-len(ranked) // SPAN)
    padded = np.full(rows * SPAN, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(ranked)] = ranked
    padded = padded.reshape(rows, SPAN)
    # the smallest of any SPAN neighbours: a tail of one row and a head of the next
    heads = np.minimum.accumulate(padded, axis=1).ravel()
    tails = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(tails[:n], heads[SPAN - 1:SPAN - 1 + n]) & mask).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:], [n])) - 1
    place = place[first]
    # the bytes before an anchor, of which a window sees them all, and those behind it; one of both is there
    before, behind = first <= place - SIDE, last >= place - SIDE
    halves = [mixed((sums[at + HALF] - sums[at]) * down[at]) ^ np.uint64(tag * BASE) for tag, at in enumerate((np.where(before, place - SIDE, 0), np.where(behind, place, 0)))]
    return place, first, last, grams[place], np.where(before, halves[0], halves[1]), np.where(behind, halves[1], halves[0])


def anchors(data: bytes):
    """For each anchor its place, the first and last window start that name it, and the hashes of its gram and of its halves.

    Where windows have room for one half only, both hashes are of that one.
    """
    found = []
    for at in range(0, max(0, len(data) - MATCH + 1), PIECE):
        part = np.frombuffer(data, np.uint8)[at:at + PIECE + MATCH - 1]
        place, first, last, *hashes = _anchors(part)
        found.append((place + at, first + at, last + at, *hashes))
    if not found:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def repeated_spans(gram: np.ndarray, contexts: list[bytes], left: np.ndarray, windows: np.ndarray, rows: np.ndarray):
    """How many bytes before and from its anchor on each context has in repeated windows; 0 and 0 for none.

    A context holds ``left`` bytes before its anchor and has ``windows`` window
    starts from its beginning on; ``rows`` occurrences share it.
    """
    n = len(contexts)
    ahead = np.frombuffer(b"".join(c[k:].ljust(MATCH, b"\0") for c, k in zip(contexts, left.tolist(), strict=True)), np.uint8).reshape(n, MATCH)
    behind = np.frombuffer(b"".join(c[:k][::-1].ljust(SPAN + 7 & ~7, b"\0") for c, k in zip(contexts, left.tolist(), strict=True)), np.uint8).reshape(n, -1)
    order_a, shared_a = deep_shallow.sort(gram, ahead)
    order_b, shared_b = deep_shallow.sort(gram, behind)
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    class_a, class_b = np.empty(n, np.int64), np.empty(n, np.int64)
    for p in range(int((left - windows).min()) + 1, int(left.max()) + 1):
        live = np.flatnonzero((p <= left) & (p > left - windows))
        if not len(live):
            continue
        class_a[order_a] = np.cumsum(shared_a < MATCH - p)
        class_b[order_b] = np.cumsum(shared_b < p)
        key = class_a[live] * (n + 1) + class_b[live]
        by = np.argsort(key)
        run = np.cumsum(np.concatenate(([0], (np.diff(key[by]) != 0).astype(np.int64))))
        hit = live[by[np.bincount(run, rows[live[by]])[run] >= 2]]
        before[hit] = np.maximum(before[hit], p)
        after[hit] = np.maximum(after[hit], MATCH - p)
    return before, after



def _data(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _halves(batches):
    for batch in batches:
        found = []
        for text in batch.text:
            *_, before, behind = anchors(_data(text))
            found += [before, behind[behind != before]]
        if found:
            yield pd.DataFrame({"hash": np.concatenate(found).view(np.int64)})


def _marks(row: int, place: np.ndarray) -> np.ndarray:
    """A hash of each place of a row."""
    return mixed(np.int64(row).view(np.uint64) ^ (place.astype(np.uint64) * np.uint64(BASE)))


def _named(data: bytes, lo: int, hi: int, at: int, gram: int) -> tuple[bytes, bytes]:
    """The name of a context, gram first, and its bytes; equal names have equal bytes around equal places."""
    context = data[lo:hi + MATCH]
    return gram.to_bytes(8, "big") + hashlib.blake2b(context, digest_size=12, salt=(at - lo).to_bytes(8, "big")).digest(), context


def _reader(halves: bytes, half_shift: int, marks: bytes | None = None, mark_shift: int = 0):
    """Reads texts for the places of repeated halves, or with ``marks`` for the contexts at the marked places."""
    bits, marked = np.frombuffer(halves, np.uint8), None if marks is None else np.frombuffer(marks, np.uint8)
    columns = ["key", "place", "left", "windows", "name", "mark"] if marks is None else ["name", "left", "context"]

    def rows(batches):
        seen: set[bytes] = set()
        for batch in batches:
            out = []
            for key, row, text in zip(batch.key, batch.row, batch.text, strict=True):
                data = _data(text)
                place, first, last, gram, before, behind = anchors(data)
                hit = in_bitmap(bits, half_shift, before) | in_bitmap(bits, half_shift, behind)
                mark = _marks(row, place)
                if marked is not None:
                    hit &= in_bitmap(marked, mark_shift, mark)
                for at, lo, hi, h, m in zip(place[hit].tolist(), first[hit].tolist(), last[hit].tolist(), gram[hit].tolist(), mark[hit].view(np.int64).tolist(), strict=True):
                    name, context = _named(data, lo, hi, at, h)
                    if marked is None:
                        out.append((key, at, at - lo, hi - lo + 1, name, m))
                    elif name not in seen:
                        seen.add(name)
                        out.append((name, at - lo, context))
                if len(seen) > SEEN_NAMES:
                    seen.clear()
                if len(out) > SENT_ROWS:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    return rows


PLACE_SCHEMA = "key binary, place long, left int, windows int, name binary, mark long"
CONTEXT_SCHEMA = "name binary, left int, context binary"
SPAN_SCHEMA = "name binary, before int, after int"


def gram_of(name: str = "name"):
    return F.substring(F.col(name), 1, 8)


def _sorted_spans(batches):
    """Spans of the contexts of whole grams; the rows come ordered by name, so by gram."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if len(held) >= SORTED_ROWS:
            last = bytes(held["name"].iloc[-1])[:8]
            open_ = np.fromiter((bytes(n)[:8] == last for n in held["name"]), bool, len(held))
            if not open_.all():
                yield _spans(held[~open_])
                held = held[open_].reset_index(drop=True)
    if held is not None and len(held):
        yield _spans(held)


def _spans(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.drop_duplicates("name")
    gram = np.array([int.from_bytes(bytes(n)[:8], "big") for n in frame["name"]], np.uint64).view(np.int64)
    windows = frame.context.map(len).to_numpy(np.int64) - MATCH + 1
    before, after = repeated_spans(gram, frame.context.tolist(), frame.left.to_numpy(np.int64), windows, np.ones(len(frame), np.int64))
    out = pd.DataFrame({"name": frame["name"].to_numpy(), "before": before, "after": after})
    return out[out.after > 0]


def _single_windows(batches):
    """Every window of every context by itself: (name, place in the window, hash of it)."""
    for batch in batches:
        out = []
        for name, left, context in zip(batch["name"], batch.left, batch.context, strict=True):
            for s in range(len(context) - MATCH + 1):
                out.append((name, left - s, hashlib.blake2b(context[s:s + MATCH], digest_size=16).digest()))
        yield pd.DataFrame(out, columns=["name", "p", "window"])


def spans_of(contexts: DataFrame, names: DataFrame, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """name, before and after of every context that shares a window with another one."""
    different = names.groupBy(gram_of().alias("gram")).agg(F.count("*").alias("different"))
    hot = materialise(different.filter(F.col("different") > hot_contexts).select("gram"), "hot")
    # the engine checks how large the table of hot grams is; a small one does not move the contexts
    calm = contexts.join(hot, gram_of() == F.col("gram"), "left_anti")
    spans = calm.repartition(gram_of()).sortWithinPartitions("name").mapInPandas(_sorted_spans, SPAN_SCHEMA)
    if hot.isEmpty():
        return spans
    single = contexts.join(hot, gram_of() == F.col("gram"), "left_semi").dropDuplicates(["name"]).mapInPandas(_single_windows, "name binary, p int, window binary")
    twice = single.groupBy("p", "window").agg(F.count("*").alias("all")).filter("all > 1").select("p", "window")
    more = single.join(twice, ["p", "window"]).groupBy("name").agg(F.max("p").alias("before"), (F.lit(MATCH) - F.min("p")).alias("after"))
    return spans.unionByName(more)


def repeated_runs(docs: DataFrame, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """key (MD5 of the text) and runs, the ordered (start, end) of its maximal repeated runs, for texts that have any."""
    texts = docs.select(F.unhex(F.md5(text_of())).alias("key"), F.xxhash64(F.col("doc_id").cast("string"), text_of()).alias("row"), text_of().alias("text"))
    twice = materialise(texts.select("text").mapInPandas(_halves, "hash long").groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "halves")
    halves = bitmap_of(twice)
    found = materialise(texts.mapInPandas(_reader(*halves), PLACE_SCHEMA), "places")
    names = materialise(found.groupBy("name").agg(F.count("*").alias("n"), F.min("mark").alias("hash")), "names")
    # a name alone in its gram has nothing to be compared with
    shared = names.groupBy(gram_of().alias("gram")).agg(F.count("*").alias("different")).filter("different > 1").select("gram")
    compared = materialise(names.join(shared, gram_of() == F.col("gram"), "left_semi").select("name", "hash"), "compared")
    contexts = texts.mapInPandas(_reader(*halves, *bitmap_of(compared.select("hash").distinct())), CONTEXT_SCHEMA)
    # a context that occurs twice is repeated as a whole; the others are compared
    whole = names.filter("n > 1").select("name", F.lit(True).alias("whole"), F.lit(0).alias("before"), F.lit(0).alias("after"))
    spans = spans_of(contexts, compared, hot_contexts).select("name", F.lit(False).alias("whole"), "before", "after")
    known = materialise(whole.unionByName(spans).groupBy("name").agg(F.max("whole").alias("whole"), F.max("before").alias("before"), F.max("after").alias("after")), "spans")
    start = F.when(F.col("whole"), F.col("place") - F.col("left")).otherwise(F.col("place") - F.col("before"))
    end = F.when(F.col("whole"), F.col("place") - F.col("left") + F.col("windows") - 1 + MATCH).otherwise(F.col("place") + F.col("after"))
    pieces = found.select("key", "place", "left", "windows", "name").join(known, "name").select("key", F.struct(start.alias("start"), end.alias("end")).alias("piece"))
    # a text has at most one piece for each of its anchors; equal texts have equal pieces
    gathered = pieces.groupBy("key").agg(F.sort_array(F.collect_set("piece")).alias("pieces"))

    def merge(batches):
        for batch in batches:
            out = []
            for pieces in batch.pieces:
                runs: list[list[int]] = []
                for piece in pieces:
                    if runs and piece["start"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], piece["end"])
                    else:
                        runs.append([piece["start"], piece["end"]])
                out.append(runs)
            yield pd.DataFrame({"key": batch.key, "runs": out})

    return materialise(gathered.mapInPandas(merge, "key binary, runs array<array<long>>"), "runs")


def cut(docs: DataFrame, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``."""
    def measure(batches):
        for batch in batches:
            out = []
            for doc_id, text, runs in zip(batch.doc_id, batch.text, batch.runs, strict=True):
                data, at, kept, removed = _data(text), 0, hashlib.sha256(), 0
                spans = [] if runs is None else runs
                for start, end in spans:
                    kept.update(data[at:start])
                    removed += end - start
                    at = end
                kept.update(data[at:])
                out.append((doc_id, len(data), removed, len(spans), kept.hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    runs = repeated_runs(docs, hot_contexts)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text")).withColumn("_key", F.unhex(F.md5("text")))
    joined = rows.join(runs, F.col("_key") == F.col("key"), "left").select("doc_id", "text", "runs")
    return joined.mapInPandas(measure, "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumn(
        "doc_id", F.col("doc_id").cast("long"))
