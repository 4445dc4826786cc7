"""Near-duplicate documents by MinHash with tensored banding.

Instead of hashing one long key per table, two small collections of ``HALVES``
half keys are made from ``ROWS`` minima each, and every pair of a half key from
the first and one from the second is the key of a table: 225 tables of ten
minima from 150 minima, where independent tables would need 2,250.  Two texts
meet when they share a half key on both sides: at the similarity of 0.85 with
a probability above 0.9995, at 0.5 with one of 0.14.

Texts with equal shingle sets are one class from the start, so a third of all
rows in copies costs one representative.  Half keys that only one class has
are dropped by a count before any pair is formed; most documents end there.

Candidates are confirmed on full shingle sets, in steps that never emit all
pairs of a group.  First each class meets the smallest class that it shares a
table with.  Tables whose classes are one component are then done: links inside
a component cannot change it.  The classes of the others may be many that are
alike but not alike enough, so they are dealt anew by their rarest shingles:
linked sets must share one of those, and classes that cannot reach 0.85 with
anything have none to share.  What is left meets a few seeded members of the main components,
and at last all classes of *different* components that share a rare shingle meet,
unless their sketches of parities differ in more bits than linked sets differ in shingles.
Every candidate of the tables is thus confirmed, implied or excluded.

Defined cases: null and empty texts have an empty set and stand alone; rows
with equal doc_id and different texts are linked like other rows; a component
of rows without doc_id has a null component_id, and one of them stays; an empty table gives an empty
result; other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import components
from .shingles import mixed, set_digest, shingle_set
from .tables import materialise

ROWS = 5  # minima in a half key
HALVES = 15  # half keys on each side
SHARED, OF = 85, 100  # linked when OF * intersection >= SHARED * union
BLOCK = 1024
SKETCH = 8  # whole numbers of 64 parities
PROBES = 8  # members of main components that a class meets in a turn
TURNS = 1

_rng = np.random.default_rng(19_970_611)
_FLIPS = _rng.integers(0, 2**63, 2 * HALVES * ROWS, dtype=np.uint64)
_FACTORS = _rng.integers(0, 2**63, 2 * HALVES * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_JOINERS = _rng.integers(0, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)


def half_keys(shingles: np.ndarray) -> np.ndarray:
    """The half keys of a set, first side first; equal keys of different places differ."""
    low = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        block = shingles[at:at + BLOCK, None]
        np.minimum(low, ((block ^ _FLIPS) * _FACTORS).min(axis=0), out=low)
    keys = (low.reshape(-1, ROWS) * _JOINERS).sum(axis=1, dtype=np.uint64)
    return mixed(keys + np.arange(len(keys), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each of 64 * SKETCH bits whether an odd number of shingles falls on it.

    Two sets' sketches differ in no more bits than the sets differ in shingles.
    """
    slots = np.bincount((mixed(shingles ^ _FLIPS[0]) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(slots.astype(np.uint8)).view(np.int64)


def _profiles(batches):
    for batch in batches:
        out = []
        for key, doc_id, text in zip(batch["key"], batch["doc_id"], batch["text"], strict=True):
            s = shingle_set(text)
            out.append((key, doc_id, len(s), set_digest(s), half_keys(s).tolist() if len(s) else [], parities(s).tolist()))
        yield pd.DataFrame(out, columns=["key", "doc_id", "n_shingles", "digest", "halves", "sketch"]).astype({"doc_id": "Int64"})


def row_key() -> Column:
    """Names a row by its id and its text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col("text").cast("string"), F.lit("")))))


def profiles(docs: DataFrame) -> DataFrame:
    """key, doc_id, n_shingles, digest of the set, half keys and sketch of every row."""
    return materialise(docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        _profiles, "key binary, doc_id long, n_shingles long, digest binary, halves array<long>, sketch array<long>"), "profiles")


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per distinct set: class, digest, low (smallest doc_id), n_shingles, halves, sketch."""
    grouped = rows.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("low"), F.max("n_shingles").alias("n_shingles"), F.min("halves").alias("halves"), F.min("sketch").alias("sketch"))
    return materialise(grouped.withColumn("class", F.monotonically_increasing_id()), "classes")


def tables_of(classes: DataFrame) -> DataFrame:
    """(key, class) of the tensored tables in which at least two classes meet."""
    halves = classes.select("class", F.posexplode("halves").alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    sides = halves.join(shared, "half", "left_semi").groupBy("class").agg(
        F.collect_list(F.when(F.col("place") < HALVES, F.col("half"))).alias("first"),
        F.collect_list(F.when(F.col("place") >= HALVES, F.col("half"))).alias("second"))
    keys = sides.select("class", F.explode("first").alias("half"), "second").select(
        "class", F.col("half").alias("one"), F.explode("second").alias("two")).select(F.xxhash64("one", "two").alias("key"), "class")
    keys = materialise(keys, "keys")
    met = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("pivot")).filter("n > 1").select("key", "pivot")
    return materialise(keys.join(met, "key"), "tables")


def texts_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, text): a text of each of these classes."""
    wanted = classes.select(F.col("low").alias("_low")).distinct()
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_low")), "left_semi")

    def digests(batches):
        for batch in batches:
            yield pd.DataFrame({"digest": [set_digest(shingle_set(t)) for t in batch.text], "text": batch.text})

    read = found.select("text").mapInPandas(digests, "digest binary, text string")
    return materialise(read.join(classes.select("digest", "class"), "digest").groupBy("class").agg(F.min("text").alias("text")), "texts")


def linked(pairs: DataFrame, texts: DataFrame, shared: int = SHARED) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def confirm(batches):
        last, other = None, None
        for batch in batches:
            good = []
            for a_text, b_text in zip(batch.a_text, batch.b_text, strict=True):
                if b_text != last:
                    last, other = b_text, shingle_set(b_text)
                own = shingle_set(a_text)
                both = len(np.intersect1d(own, other, assume_unique=True))
                good.append(OF * both >= shared * (len(own) + len(other) - both))
            yield batch.loc[good, ["a", "b"]]

    first = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("a_text")), "a")
    both = first.join(texts.select(F.col("class").alias("b"), F.col("text").alias("b_text")), "b")
    return materialise(both.select("a", "b", "a_text", "b_text").mapInPandas(confirm, "a long, b long"), "links")


def rare_tables(texts: DataFrame, classes: DataFrame, shared: int = SHARED) -> DataFrame:
    """(key, class, n_shingles, rest, short): the rarest shingles of each class among these classes, so many that linked sets share one.

    A set of n shingles shares at least 85 % of them with any set that it is
    linked with, so not all of its rarest ones, n - ceil(0.85 n) + 1, can be
    missing there.  A class of which so many occur nowhere else leaves for good.
    Where the other set is no smaller, they share even 2 * 0.85 / 1.85 of the
    smaller one's; ``short`` tells the rows that are rare enough for that.
    ``rest`` counts the shingles of the class behind this one in the common order.
    """
    wanted = texts.join(classes, "class")

    def shingles(batches):
        for batch in batches:
            for name, n, text in zip(batch["class"], batch.n_shingles, batch.text, strict=True):
                yield pd.DataFrame({"key": shingle_set(text).view(np.int64)}).assign(**{"class": name, "n_shingles": n})

    spread = materialise(wanted.select("class", "n_shingles", "text").mapInPandas(shingles, "key long, class long, n_shingles long"), "shingles")
    uses = spread.groupBy("key").agg(F.count("*").alias("uses")).filter("uses > 1")
    mine = Window.partitionBy("class")
    placed = spread.join(uses, "key").withColumns({
        "place": F.row_number().over(mine.orderBy("uses", "key")), "elsewhere": F.count("*").over(mine)})
    # whole numbers, rounded up
    needed = F.expr(f"(n_shingles * {shared} + {OF - 1}) div {OF}")
    more = F.expr(f"(2 * n_shingles * {shared} + {OF + shared - 1}) div {OF + shared}")
    return materialise(placed.filter(F.col("place") <= F.col("elsewhere") - needed + 1).select(
        "key", "class", "n_shingles", (F.col("elsewhere") - F.col("place")).alias("rest"),
        (F.col("place") <= F.col("elsewhere") - more + 1).alias("short")), "rare")


def open_rows(tables: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, class, component, main, n_shingles, rest) of the tables in which different components meet; main is a table's largest."""
    placed = tables.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    return materialise(placed.join(main.select("key", "main"), "key"), "open")


def similar_sizes(a: str, b: str, shared: int = SHARED) -> Column:
    return F.least(a, b) * OF >= F.greatest(a, b) * shared


def probes(rows: DataFrame, turn: int, shared: int = SHARED) -> DataFrame:
    """Pairs of a class outside a table's main component with a seeded member of it, at most ``PROBES`` for a class."""
    order = F.xxhash64("class", F.lit(turn))
    pivots = rows.filter("component = main").groupBy("key").agg(F.min_by(F.struct("class", "n_shingles"), order).alias("pivot"))
    met = rows.filter("component != main").join(pivots, "key").filter(similar_sizes("n_shingles", "pivot.n_shingles", shared)).select(
        F.col("class").alias("a"), F.col("pivot.class").alias("b")).distinct()
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.xxhash64("b", F.lit(turn)), "b"))
    return met.withColumn("place", place).filter(F.col("place") <= PROBES).select("a", "b")


def cross_pairs(rows: DataFrame, classes: DataFrame, shared: int = SHARED) -> DataFrame:
    """Distinct pairs of classes of different components that share a rare shingle and may be similar.

    If it is the first shingle that they share, the sets have at most that one and
    what follows it in common.  That must be enough; a pair of similar sets passes at its first one.
    The sketches drop pairs that surely differ in more shingles than linked sets may,
    (n_a + n_b) * (1 - s) / (1 + s), before they become rows.
    """
    bits = [F.get("sketch", F.lit(i)).alias(f"s{i}") for i in range(SKETCH)]
    known = materialise(rows.join(classes.select("class", *bits), "class"), "sketched")
    a, b = known.filter("component != main").alias("a"), known.alias("b")
    both = F.col("a.n_shingles") + F.col("b.n_shingles")
    enough = (F.least("a.rest", "b.rest") + 1) * (OF + shared) >= both * shared
    short = F.when(F.col("a.n_shingles") <= F.col("b.n_shingles"), F.col("a.short")).otherwise(F.col("b.short"))
    differ = sum((F.bit_count(F.col(f"a.s{i}").bitwiseXOR(F.col(f"b.s{i}"))) for i in range(SKETCH)), F.lit(0))
    near = differ * (OF + shared) <= both * (OF - shared)
    # a pair of two outsiders comes up from both sides; distinct makes it one
    return a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component")) & similar_sizes(
        "a.n_shingles", "b.n_shingles", shared) & short & enough & near).select(
        F.greatest("a.class", "b.class").alias("a"), F.least("a.class", "b.class").alias("b")).distinct()


def component_labels(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("class"), "component")


def grouped_rows(docs: DataFrame, shared: int = SHARED) -> DataFrame:
    """key, doc_id, n_shingles, component_id and group (a number of the component, null for an empty set) of every row."""
    rows = profiles(docs)
    classes = classes_of(rows)
    tables = tables_of(classes)
    texts = texts_of(docs, classes.join(tables.select("class").distinct(), "class", "left_semi"))
    stars = tables.filter("class != pivot").groupBy("class").agg(F.min("pivot").alias("b")).select(F.col("class").alias("a"), "b")
    links = linked(stars, texts, shared)
    rows_open = open_rows(tables.select("key", "class").join(classes.select("class", "n_shingles"), "class"), component_labels(links))
    rare = rare_tables(texts, rows_open.select("class", "n_shingles").distinct(), shared)
    for turn in range(TURNS):
        links = links.unionByName(linked(probes(open_rows(rare, component_labels(links)), turn, shared), texts, shared))
    links = links.unionByName(linked(cross_pairs(open_rows(rare, component_labels(links)), classes, shared), texts, shared))
    labels = materialise(component_labels(links), "labels")
    named = classes.select("class", "digest", "low").join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    by_set = materialise(named.join(lows, "component").select("digest", "component_id", F.col("component").alias("group")), "sets")
    out = rows.select("key", "doc_id", "n_shingles", "digest").join(by_set, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("key", "doc_id", "n_shingles", component.alias("component_id"), "group")


def near_duplicates(docs: DataFrame, shared: int = SHARED) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``; linked from a similarity of ``shared`` per cent."""
    return grouped_rows(docs, shared).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, shared: int = SHARED) -> DataFrame:
    """The rows of ``docs`` that stay, unchanged: of each component the one with the smallest doc_id, one without id only where no other is there."""
    rows = materialise(grouped_rows(docs, shared).filter(F.col("group").isNotNull()).select("key", "doc_id", "group"), "grouped")
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    gone = materialise(rows.join(first, "group").filter(F.col("key") != F.col("first.key")).select(F.col("key").alias("__gone")).distinct(), "gone")
    return docs.join(gone, row_key() == F.col("__gone"), "left_anti")
