"""Repeated word sequences, Merkle proofs and hard negatives against brute force and on messy rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

import messy
from fleetgrid.llm import hard_negatives, merkle, recompression
from fleetgrid.llm.shingles import word_hashes

KEY = lambda row: repr(row)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=KEY)


@pytest.fixture(scope="module")
def docs(spark):
    return messy.documents(spark).cache()


def test_cut_words_of_messy_rows(docs):
    assert collected(recompression.digests(docs)) == sorted(messy.cut_words([r[:2] for r in messy.rows()]), key=KEY)


def test_cut_words_of_empty_tables(spark):
    assert recompression.digests(messy.documents(spark, [])).count() == 0
    assert merkle.verified_rows(messy.documents(spark, [])).count() == 0


def test_cut_words_in_runs_and_periods(spark):
    rng = random.Random(5)
    data = [(1, "a " * 400), (2, "a " * 12), (3, "x " + "a " * 13 + "y"), (4, "a b " * 300), (5, "b a " * 20), (6, "c " * 100_000), (7, "d " + "c " * 30),
            (8, messy.prose(1, 200)), (8, messy.prose(1, 200)), (None, messy.prose(1, 200)), (None, "q w " * 40), (None, "q w " * 40)]
    # small alphabets: many repeats at all places of all lengths
    data += [(20 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(5, 120)))) for i in range(60)]
    data += [(100 + i, " ".join(rng.choice("abcdef") for _ in range(40)) + " " + messy.prose(2, 300)[i * 7:i * 40]) for i in range(40)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert collected(recompression.digests(df)) == sorted(messy.cut_words(data), key=KEY)


def test_cut_words_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(recompression, "PIECE", 50)
    text = messy.prose(3, 400)
    words = text.split()
    data = [(1, text), (2, " ".join(words[37:130])), (3, "other " + " ".join(words[200:390]))]
    monkeypatch.setattr(recompression, "SLICE", 300)
    batch = pa.RecordBatch.from_pydict({"doc": [d for d, _ in data], "text": [t for _, t in data]})
    windows = [len(seq.windows) for *_, seq in recompression._read(iter([batch]), units=True)]
    assert sum(windows) == sum(len(t.split()) - 12 for _, t in data) and len(windows) > 3


def test_words_of_a_buffer():
    texts = ["", "one", " two  three\x0bfour ", "x", "\n", "ü ö\u00a0ß", ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    edges = np.cumsum([0, *(len(t.encode()) for t in texts)])
    start, end = recompression._words(data, edges)
    words = [w for t in texts for w in t.encode().split()]
    assert [bytes(data[a:b]) for a, b in zip(start, end)] == words
    assert (recompression._hashed(data, start, end) == word_hashes(words)).all()


def test_runs_removed_are_whole_spans(spark):
    shared = messy.prose(4, 30)
    df = spark.createDataFrame([(1, shared), (2, "one two " + shared + " three")], "doc_id long, text string")
    row = {r.doc_id: r for r in recompression.cut(df).collect()}
    assert row[2].removed == [[2, 32]] and row[2].kept == "one two three" and row[1].removed == [] and row[1].kept == shared


def test_a_third_of_all_rows_hold_one_passage(spark):
    passage = messy.prose(5, 60)
    data = [(i, f"{messy.prose(100 + i, 20)} {passage if i % 3 == 0 else messy.prose(900 + i, 60)} {messy.prose(500 + i, 9)}") for i in range(600)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    assert collected(recompression.digests(df)) == sorted(messy.cut_words(data), key=KEY)


def test_windows_know_their_cores():
    # the same window in different surroundings has the same core
    words = messy.prose(6, 13).split()
    cores = set()
    for seed in range(30):
        around = messy.prose(50 + seed, 20).split()
        text = [w.encode() for w in around[:seed % 12] + words + around[12:]]
        seq = recompression.Sequences(word_hashes(text), np.array([len(text)])).parse(units=False)
        cores.add(int(seq.core[seed % 12]))
    assert len(cores) == 1


def test_proofs_of_messy_rows(spark, docs):
    different = {r[0]: r for r in messy.rows()}
    data = [(d, s, lang, n, t) for d, t, lang, s, n in different.values()]
    rows = messy.documents(spark, [(d, t, lang, s, n) for d, s, lang, n, t in data])
    assert collected(merkle.verified_rows(rows)) == sorted(messy.proofs(data), key=KEY)
    # rows that repeat follow each other
    out = merkle.verified_rows(docs).collect()
    assert len(out) == len(messy.rows()) and len({r.root for r in out}) == 1


@pytest.mark.parametrize("rows,sources", [(1, 1), (16, 1), (17, 1), (5, 5), (40, 40), (700, 3), (300, 20)])
def test_proofs_of_trees_of_all_heights(spark, rows, sources, monkeypatch):
    monkeypatch.setattr(merkle, "SENT_BYTES", 4000 if rows == 700 else 1 << 20)
    data = [(i, None if i % sources == 0 else f"s{i % sources if i % 2 else 0}", "en", i, messy.prose(i, 3).title()) for i in range(rows)]
    df = spark.createDataFrame([(d, t, lang, s, n) for d, s, lang, n, t in data], messy.DOC_SCHEMA)
    out = merkle.verified_rows(df)
    assert collected(out) == sorted(messy.proofs(data), key=KEY)


def vectors(seed: int, n: int, width: int):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, width))
    label = rng.integers(0, 10, n)
    v = centres[label] * 0.3 + rng.normal(size=(n, width)) * 0.3
    return [(i, v[i].astype(np.float32).tolist(), int(label[i])) for i in range(n)]


EMBEDDED = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block,group,tile", [(16_384, 1 << 14, 1 << 21), (2, 150, 1 << 10)])
def test_hard_negatives(spark, monkeypatch, block, group, tile):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", group)
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    data = vectors(1, 1200, 16)
    data += [(2000 + i, data[5][1], 3) for i in range(400)]  # a vector that a quarter of all rows hold
    data += [(5000, None, 1), (5001, [1.0, None], 1), (5002, [float("nan")] * 16, 2), (5003, [float("inf")] * 16, 2), (5004, [1.0] * 16, None),
             (None, [1.0] * 16, 1), (5005, [0.5, 0.25], 4), (5006, [], 4), (5100, [0.0] * 16, 2)]
    df = spark.createDataFrame(data, EMBEDDED).selectExpr("*", "1 AS score", "2 AS anchor", "3 AS whole", "4 AS block").repartition(4)
    assert collected(hard_negatives.hard_negatives(df)) == sorted(messy.negatives(data), key=KEY)


def test_hard_negatives_without_rows(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], EMBEDDED)).count() == 0
    one = spark.createDataFrame([(100, [1.0, 2.0], 1)], EMBEDDED)
    assert hard_negatives.hard_negatives(one).count() == 0
    with pytest.raises(ValueError, match="long"):
        hard_negatives.hard_negatives(spark.createDataFrame([(100, [1e30, 2.0], 1)], EMBEDDED))


@pytest.mark.parametrize("width,size", [(64, 300), (1, 30_000), (3000, 900)])
def test_scores_are_exact(width, size):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-size, size, (20, width)), rng.integers(-size, size, (30, width))
    primes = hard_negatives.primes_for(width, float(size) ** 2 * width)
    got = hard_negatives.scores(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
    assert (got == a @ b.T).all()
