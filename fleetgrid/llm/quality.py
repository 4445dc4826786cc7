"""Quality scores from compression with two dictionaries.

One zstandard dictionary is trained on text labelled good, one on text
labelled bad.  A text is compressed with both, in pieces of ``PIECE`` bytes so
that a long text cannot teach the compressor itself.  The difference of the
two sizes, normalised by their sum and by the length, becomes a probability
through a logistic fit that also sees the compressed share and the length.

Training reads a bounded sample of labelled rows, never the corpus: ids are
ordered by a fixed hash and at most ``DICTIONARY_ROWS`` and
``CALIBRATION_ROWS`` of each class are taken, and of the first at most
``PIECES`` pieces.  One half of the training remainders gives the
dictionaries, the other the calibration, so a text never helps to compress
itself.  Every row of the table is scored, over its whole text.

Defined cases: null text counts as empty; ids with contradicting or null
labels are not learned from; without labelled text of both classes every score
is 0.5; a null doc_id is not held out; an empty table gives an empty result;
other columns, labels included, never reach a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .tables import text_of

PIECE = 1024
DICTIONARY_BYTES = 65_536
LEVEL = 3
DICTIONARY_ROWS = 3_000
CALIBRATION_ROWS = 4_000
CALIBRATION = [1, 3]  # remainders of the ids that the fit learns from
PIECES = 8_000
ACCEPT = 0.7  # fixed value: a score from here on predicts label 1
RIDGE = 1e-4


def remainder() -> Column:
    """crc32 of doc_id as text, modulo 4."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def held_out() -> Column:
    return F.coalesce(remainder() == 2, F.lit(False))


def agreed_ids(labels: DataFrame, remainders: list[int]) -> DataFrame:
    """doc_id and quality of the ids whose labels agree, each once."""
    return labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(remainder().isin(remainders)).groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("_other")).filter("quality = _other").drop("_other")


def labelled_ids(labels: DataFrame, remainders: list[int], rows: int) -> DataFrame:
    """At most ``rows`` of the agreed ids of each class."""
    agreed = agreed_ids(labels, remainders)
    order = F.md5(F.col("doc_id").cast("string"))
    picked = [agreed.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(rows) for q in (0, 1)]
    return picked[0].unionByName(picked[1])


def pieces_of(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[i:i + PIECE] for i in range(0, len(data), PIECE)]


def sampled_pieces(docs: DataFrame, ids: DataFrame, limit: int = PIECES) -> dict[int, list[bytes]]:
    """At most ``limit`` pieces of each class, in a fixed order."""
    ids = F.broadcast(ids.withColumnRenamed("doc_id", "_id"))
    texts = docs.select("doc_id", text_of().alias("text")).join(ids, F.col("doc_id") == F.col("_id"))

    def cut(batches):
        for batch in batches:
            for doc_id, quality, text in zip(batch.doc_id, batch.quality, batch.text, strict=True):
                cuts = pieces_of(text)
                yield pd.DataFrame({"doc_id": doc_id, "quality": quality, "number": np.arange(len(cuts)), "piece": cuts})

    cuts = texts.select("doc_id", "quality", "text").mapInPandas(cut, "doc_id long, quality int, number long, piece binary")
    order = [F.md5(F.concat_ws(":", "doc_id", "number")), "doc_id", "number", "piece"]
    return {q: [bytes(r.piece) for r in cuts.filter(F.col("quality") == q).orderBy(*order).limit(limit).collect()] for q in (0, 1)}


def trained_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the samples; too few of them become the dictionary themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


@dataclass
class Scorer:
    """Two dictionaries and a logistic fit; small enough to travel with every task."""

    good: bytes
    bad: bytes
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_packers"}

    def packers(self):
        if "_packers" not in self.__dict__:
            made = []
            for data in (self.good, self.bad):
                dictionary = zstandard.ZstdCompressionDict(data)
                dictionary.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False))
            self._packers = made
        return self._packers

    def features(self, texts) -> np.ndarray:
        """One row a text: normalised size difference, compressed share, log length, difference per byte."""
        good, bad = self.packers()
        out = np.empty((len(texts), 4))
        for i, text in enumerate(texts):
            cuts = pieces_of(text or "")
            size, g, b = sum(map(len, cuts)), sum(len(good.compress(c)) for c in cuts), sum(len(bad.compress(c)) for c in cuts)
            out[i] = (b - g) / (b + g + 32), (g + 16) / (size + 64), np.log(size + 64), (b - g) / (size + 64)
        return out

    def design(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale, -8, 8)
        squares = [z[:, i] * z[:, j] for i in range(z.shape[1]) for j in range(i, z.shape[1])]
        return np.column_stack([np.ones(len(z)), z, *squares])

    def fit(self, features: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Weighted ridge logistic regression by Newton's method."""
        self.mean, self.scale = features.mean(0), features.std(0) + 1e-9
        x, sample = self.design(features), weights / weights.sum()
        ridge = np.full(x.shape[1], RIDGE)
        ridge[0] = 1e-9
        w = np.zeros(x.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (sample * (p - labels)) + ridge * w
            curve = (x * (sample * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(ridge)
            step = np.linalg.solve(curve, gradient)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def scores(self, texts) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.design(self.features(texts)) @ self.weights, -30, 30)))


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    """A scorer from the labelled rows whose remainder is not 2."""
    samples = sampled_pieces(docs, labelled_ids(labels, [0], DICTIONARY_ROWS))
    if not all(any(s) for s in samples.values()):
        return Scorer(b"", b"")
    scorer = Scorer(trained_dictionary(samples[1]), trained_dictionary(samples[0]))
    ids = F.broadcast(labelled_ids(labels, CALIBRATION, CALIBRATION_ROWS).withColumnRenamed("doc_id", "_id"))

    def measure(batches):
        for batch in batches:
            yield pd.DataFrame(scorer.features(batch.text), columns=list("abcd")).assign(quality=batch.quality.to_numpy(), doc_id=batch.doc_id.to_numpy())

    measured = docs.select("doc_id", text_of().alias("text")).join(ids, F.col("doc_id") == F.col("_id")).select("doc_id", "quality", "text").mapInPandas(
        measure, "a double, b double, c double, d double, quality int, doc_id long").toPandas().sort_values(["doc_id", "a", "b", "c", "d"])
    y = measured.quality.to_numpy(float)
    if y.min(initial=1) == y.max(initial=0) or not len(y):
        return Scorer(b"", b"")
    totals = {r.quality: r["count"] for r in agreed_ids(labels, CALIBRATION).groupBy("quality").count().collect()}
    weights = np.where(y == 1, totals[1] / max(1, y.sum()), totals[0] / max(1, (1 - y).sum()))
    scorer.fit(measured[list("abcd")].to_numpy(), y, weights)
    return scorer


def score_column(scorer: Scorer) -> Column:
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(scorer.scores(text.tolist()))

    return score(text_of())


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    scored = docs.select("doc_id", "text").withColumn("score", score_column(train(docs, labels)))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, unchanged."""
    return docs.withColumn("_score", score_column(train(docs, labels))).filter(F.col("_score") >= ACCEPT).drop("_score")
