"""Hard negatives by exact inner products in a residue number system.

Vectors become whole numbers.  A task multiplies a block of anchors with
blocks of rows once for every one of a few small primes: residues around zero
go through an ordinary ``float32`` matrix product, whose sums stay below 2**24
and are therefore exact, and Chinese remaindering turns the remainders into
the exact signed score.  The number of primes follows from the longest vector
(no score exceeds the product of two lengths).

The rows are dealt to (block of anchors, group of rows).  A task holds its
anchors and the best rows so far, and streams through the rows of its group,
so its memory does not depend on the number of rows.  Two passes are made: the
first finds every anchor's positives, the second, with the ranges that these
set, their negatives.  Each task sends the best of its group only, and a window
per anchor and positive selects among them; their number is fixed by the
number of groups.  Rows travel once for every block of ``BLOCK`` anchors.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part, and neither do rows without ``vec_id``, which nothing
could name; a vector that is shorter than the longest counts as filled with
zeros; a row is another row than the anchor when its ``vec_id`` differs; rows
that repeat are rows of their own, and a repeated anchor gives its rows
again; an anchor without positives, and a positive without negatives in range,
give no row; an empty table gives an empty result; other columns are never
looked at.  Vectors so long that a score might reach 2**50 are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .tables import materialise

ANCHORS, RELABELLED, LABELS = 100, 7, 10  # the ids they divide, and the labels these turn over
SCALE = 256.0
POSITIVES, NEGATIVES = 5, 10
LOWEST, HIGHEST = 30, 90  # per cent of the positive's score
BLOCK = 16_384  # anchors that a task holds
GROUP_ROWS = 1 << 14  # rows of a group, until there are as many groups as the cluster runs
GROUPS = 16  # most groups of rows for a block of anchors
TILE = 1 << 21  # scores that are looked at together
EXACT = 1 << 24  # whole numbers below are exact in float32
CHUNK = 1024  # components that are summed in one product
MOST_SCORE = 1 << 50


def primes_for(width: int, bound: float) -> list[int]:
    """Primes whose residues around zero sum exactly over ``width`` components, enough of them for scores up to ``bound``."""
    half = int((EXACT / max(1, min(width, CHUNK))) ** 0.5)
    number, product, out = min(2 * half + 1, 4093), 1, []
    while product <= 2 * bound + 2:
        if all(number % d for d in range(2, int(number ** 0.5) + 1)):
            out.append(number)
            product *= number
        number -= 1
        if number < 2:
            raise ValueError("vectors too long for exact scores")
    return out


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """For each prime the residues around zero."""
    out = []
    for p in primes:
        r = np.remainder(vectors, p)
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The exact inner products of all rows of ``left`` and ``right``, given as residues."""
    value, product = None, 1
    for a, b, p in zip(left, right, primes, strict=True):
        rest = np.zeros((len(a), len(b)), np.float32)
        for at in range(0, a.shape[1], CHUNK):
            rest = np.fmod(a[:, at:at + CHUNK] @ b[:, at:at + CHUNK].T, np.float32(p)) + rest
        rest = rest.astype(np.int64) % p
        if value is None:
            value, product = rest, p
            continue
        # the multiple of the product so far that gives this remainder as well
        value += product * ((rest - value) * pow(product, -1, p) % p)
        product *= p
    return np.where(value > product // 2, value - product, value)


class Best:
    """The best ``k`` rows of every anchor: higher scores first, ties by smaller id."""

    NONE = np.iinfo(np.int64).min

    def __init__(self, anchors: int, k: int):
        self.k = k
        self.score = np.full((anchors, k), self.NONE, np.int64)
        self.id = np.full((anchors, k), np.iinfo(np.int64).max, np.int64)

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Takes the scores of the anchors ``at`` (NONE: not to be taken) with rows in ascending order of ``ids``."""
        live = np.flatnonzero((score.max(axis=1, initial=self.NONE) >= self.score[at, -1]) & (score.max(axis=1, initial=self.NONE) > self.NONE))
        if not len(live):
            return
        at, score = at[live], score[live]
        if score.shape[1] > self.k:
            # place in a whole number of its own: of equal scores the first is the largest
            spread = np.int64(score.shape[1])
            ranked = np.where(score == self.NONE, self.NONE, score * spread + (spread - 1 - np.arange(spread)))
            picked = np.argpartition(ranked, -self.k, axis=1)[:, -self.k:]
            score, ids = np.take_along_axis(score, picked, 1), ids[picked]
        else:
            ids = np.broadcast_to(ids, score.shape)
        both, named = np.concatenate((self.score[at], score), 1), np.concatenate((self.id[at], np.where(score == self.NONE, np.iinfo(np.int64).max, ids)), 1)
        order = np.lexsort((named, -np.maximum(both, -MOST_SCORE)), axis=1)[:, :self.k]
        self.score[at], self.id[at] = np.take_along_axis(both, order, 1), np.take_along_axis(named, order, 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, place = np.nonzero(self.score > self.NONE)
        return at, self.score[at, place], self.id[at, place]


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow column as rows of whole numbers, filled with zeros."""
    lengths = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten()).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def components(df: DataFrame, vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """vec_id, label (as it counts) and whole components of the rows that take part."""
    label = F.col("label").cast("long")
    turned = F.when(F.col("vec_id") % RELABELLED == 0, (label + 1) % LABELS).otherwise(label)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    used = df.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.col(vector).isNotNull()).filter(finite)
    return used.select(F.col("vec_id").cast("long").alias("vec_id"), turned.alias("label"), whole.alias("whole"))


class _Task:
    """The anchors of a block, and what a group of rows has for them."""

    def __init__(self, width: int, primes: list[int]):
        self.width, self.primes = width, primes
        self.parts: list[tuple] = []

    def hold(self, batch: pa.RecordBatch) -> None:
        self.parts.append((np.asarray(batch["anchor"]), np.asarray(batch["vec_id"]), np.asarray(batch["label"]), _matrix(batch["whole"], self.width),
                           np.asarray(batch["ranges"].flatten()).reshape(-1, 2 * POSITIVES)))

    def begin(self) -> None:
        self.anchor, self.ids, self.labels, vectors, self.ranges = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.left = residues(vectors, self.primes)
        self.parts = []

    def tiles(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        """Scores of some anchors and the rows, which come in order of their ids."""
        right = residues(vectors, self.primes)
        step = max(1, TILE // max(1, len(ids)))
        for at in range(0, len(self.ids), step):
            some = np.arange(at, min(at + step, len(self.ids)))
            score = scores([a[some] for a in self.left], right, self.primes)
            yield some, score, self.labels[some, None] == labels


def _searched(width: int, primes: list[int], negatives: bool):
    """Streams through rows ordered by (block, group, rows last); the anchors of a block and group come first."""
    def end(task: _Task, best: list[Best]):
        for number, b in enumerate(best):
            at, score, ids = b.rows()
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(task.anchor[at]), pa.array(task.ids[at]), pa.array(np.full(len(at), number + 1, np.int32)), pa.array(ids), pa.array(score)],
                    names=["anchor", "anchor_id", "number", "found_id", "score"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, task, best = None, None, []
        for batch in batches:
            keys = np.asarray(batch["block"]) * (GROUPS + 1) + np.asarray(batch["group"])
            is_row = np.asarray(batch["is_row"].cast(pa.int8()))
            cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(is_row) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if hi == lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if keys[lo] != key:
                    if best:
                        yield from end(task, best)
                    key, task, best = keys[lo], _Task(width, primes), []
                if not is_row[lo]:
                    task.hold(part)
                    continue
                if not best:
                    if not task.parts:
                        continue  # a block without anchors
                    task.begin()
                    best = [Best(len(task.ids), NEGATIVES) for _ in range(POSITIVES)] if negatives else [Best(len(task.ids), POSITIVES)]
                step = max(1, min(4096, (1 << 24) // max(1, width)))
                for at in range(0, hi - lo, step):
                    piece = part.slice(at, step)
                    order = np.argsort(np.asarray(piece["vec_id"]), kind="stable")
                    ids, labels = np.asarray(piece["vec_id"])[order], np.asarray(piece["label"])[order]
                    vectors = _matrix(piece["whole"], width)[order]
                    for some, score, same in task.tiles(ids, labels, vectors):
                        if not negatives:
                            best[0].add(some, np.where(same & (task.ids[some, None] != ids), score, Best.NONE), ids)
                            continue
                        score = np.where(same, Best.NONE, score)
                        for b, low, high in zip(best, task.ranges[some, 0::2].T, task.ranges[some, 1::2].T, strict=True):
                            b.add(some, np.where((score >= low[:, None]) & (score <= high[:, None]), score, Best.NONE), ids)
        if best:
            yield from end(task, best)

    return rows


FOUND = "anchor long, anchor_id long, number int, found_id long, score long"


def _search(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int, width: int, primes: list[int], negatives: bool) -> DataFrame:
    """Every anchor's best rows of each group of rows."""
    # anchors go to every group of rows, rows to every block of anchors
    held = anchors.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("is_row", F.lit(False))
    none = F.array().cast("array<long>")
    sent = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).cast("long").alias("anchor"), "vec_id", "label", "whole",
        none.alias("ranges"), F.pmod(F.xxhash64("vec_id", "whole"), F.lit(groups)).cast("int").alias("group"), F.lit(True).alias("is_row"))
    dealt = held.select(*sent.columns).unionByName(sent).repartition(blocks * groups, "block", "group").sortWithinPartitions("block", "group", "is_row")
    return dealt.mapInArrow(_searched(width, primes, negatives), FOUND)


def _selected(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` of each key, with their rank from 1."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("found_id").asc()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def mine(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score and negative_score of every hard negative."""
    spark = df.sparkSession
    rows = components(df, vector)
    longest, width, found = rows.agg(
        F.max(F.aggregate(F.transform("whole", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, x: a + x)),
        F.max(F.size("whole")), F.count("*")).first()
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, positive_score long, negative_score long")
    bound = 1.001 * longest + 1  # no inner product exceeds the square of the longest length
    if bound >= MOST_SCORE:
        raise ValueError("a vector is so long that scores would not be exact")
    primes = primes_for(width, bound)
    rows = rows.withColumn("whole", F.col("whole").cast("array<int>"))
    chosen = rows.filter(F.col("vec_id") % ANCHORS == 0)
    # written, so that an anchor has the same number in both passes
    anchors = materialise(chosen.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    blocks = max(1, -(-anchors.count() // BLOCK))
    groups = max(1, min(GROUPS, -(-found // GROUP_ROWS)))
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int")
    anchors = anchors.select(block.alias("block"), "anchor", "vec_id", "label", "whole")

    near = _search(anchors.withColumn("ranges", F.array(*[F.lit(0).cast("long")] * 2 * POSITIVES)), rows, blocks, groups, width, primes, False)
    positives = materialise(_selected(near, ["anchor"], POSITIVES).select(
        "anchor", "anchor_id", F.col("rank").alias("positive_rank"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # in exact whole numbers: quotients are rounded towards the inside of the range
    low, high = F.expr(f"({LOWEST} * positive_score + 99 - pmod({LOWEST} * positive_score + 99, 100)) div 100"), F.expr(
        f"({HIGHEST} * positive_score - pmod({HIGHEST} * positive_score, 100)) div 100")
    wanted = [F.coalesce(F.max(F.when(F.col("positive_rank") == i, side)), F.lit(empty)).cast("long").alias(f"r{i}{empty}")
              for i in range(1, POSITIVES + 1) for side, empty in ((low, 1), (high, 0))]
    ranges = positives.groupBy("anchor").agg(*wanted)
    ranges = ranges.select("anchor", F.array(*[c for c in ranges.columns if c != "anchor"]).alias("ranges"))
    far = _search(anchors.join(ranges, "anchor"), rows, blocks, groups, width, primes, True)
    negatives = _selected(far.drop("anchor_id"), ["anchor", "number"], NEGATIVES).select(
        "anchor", F.col("number").alias("positive_rank"), "rank", F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return positives.join(negatives, ["anchor", "positive_rank"]).select(
        "anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(df: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return mine(df).drop("positive_rank")


SQL = f"""
WITH used AS (
    SELECT vec_id, CASE WHEN vec_id % {RELABELLED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS whole
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS found_id, a.label = b.label AS same, CAST(list_inner_product(a.whole, b.whole) AS BIGINT) AS score
    FROM used a JOIN used b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % {ANCHORS} = 0),
positives AS (
    SELECT anchor_id, found_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, found_id) <= {POSITIVES}),
negatives AS (
    SELECT p.*, s.found_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.found_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND {LOWEST} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGHEST} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= {NEGATIVES}
"""
