"""The registered corpus queries and the pipeline over the smallest tables."""

import base64
import decimal
import glob
import hashlib
import os
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
import messy
from fleetgrid.llm import queries
from test_documents import brute_leaks

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not found")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return int(value) if isinstance(value, decimal.Decimal) else value


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    result = duck.execute(queries.ORACLES[name])
    found = [c[0] for c in result.description]
    assert sorted(found) == sorted(df.columns)
    want = sorted((tuple(plain(v) for v in row) for row in result.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in found) for r in df.collect()), key=repr) == want and want


def test_every_number_has_a_query():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_near_copies(spark, duck):
    data = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    out = queries.QUERIES["op2_minhash_near_dedup"](spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted(messy.near_components(data))


def test_archive(spark, duck):
    data, low = duck.execute("SELECT page_id, coalesce(html, '') FROM pages").fetchall(), {}
    for i, h in data:
        low[h] = min(low.get(h, i), i)
    want = [(i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "response" if low[h] == i else "revisit", None if low[h] == i else low[h]) for i, h in data]
    out = queries.QUERIES["op3_warc"](spark, SF_DIR).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == sorted(want)


def test_leaks(spark, duck):
    want = brute_leaks(duck.execute("SELECT doc_id, text FROM documents").fetchall(), duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    out = queries.QUERIES["op5_benchmark_decontamination"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.item_id) for r in out if not r.reparameterised} == want and want


def test_cut_texts(spark, duck):
    data = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    out = queries.QUERIES["op9_suffix_array_dedup"](spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == sorted(messy.cut_texts(data))


def test_repeated_words(spark, duck):
    data = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    out = queries.QUERIES["op11_substring_dedup"](spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == sorted(messy.cut_words(data))


def test_held_out_quality(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.QUERIES["op10_quality_classifier"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    seen = Counter((labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels)
    assert (seen[0, 0] + seen[1, 1]) / seen.total() >= 0.97 and seen[1, 0] / (seen[1, 0] + seen[1, 1]) <= 0.02


def test_secrets_of_unseen_documents(spark):
    rows = queries.QUERIES["op1_secret_scans"](spark, "/root/testdata/sf0.01").collect()
    unseen = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert unseen and sum(r.is_secret == (not r.candidate.isdigit()) for r in unseen) >= 0.95 * len(unseen)


def test_stages_in_turn(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "minhash_near_dedup", "benchmark_decontamination", "source_mixing"]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in kept.collect()}
        stage(spark, kept, SF_DIR).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in kept.collect()}
        gone = before.keys() - after.keys()
        data = [(d, r.text) for d, r in before.items()]
        if number < 4:
            assert kept.columns == docs.columns and all(after[d] == before[d] for d in after)
        if name == "quality_classifier":
            judged = queries.QUERIES["op10_quality_classifier"](spark, SF_DIR).collect()
            assert after.keys() == {r.doc_id for r in judged if r.predicted == 1} and gone
        elif name == "exact_dedup":
            low = {}
            for d, t in data:
                key = " ".join((t or "").replace("\n", " ").split(" ")) if t else ""
                low[key] = min(low.get(key, d), d)
            assert after.keys() == set(low.values())
        elif name == "minhash_near_dedup":
            assert after.keys() == {d for d, _, c in messy.near_components(data) if d == c}
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            assert gone == {d for d, _ in brute_leaks(data, items)}
        else:
            assert kept.columns == [*[c for c in docs.columns if c != "size"], "size", "source_size", "target", "taken"]
            taken = Counter()
            for r in after.values():
                taken[r.source] += r.taken
            assert all(abs(taken[r.source] - r.target) <= 2 for r in after.values())
    rows = sorted(corpus_pipeline.run(spark, SF_DIR).collect(), key=repr)
    assert rows == sorted(kept.collect(), key=repr)


def test_stages_take_messy_rows(spark, tmp_path):
    docs = messy.documents(spark)
    sf_dir = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame([(1, messy.prose(10, 40))], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, sf_dir)
    assert {r.doc_id for r in docs.collect()} >= {1, 7, 9, 11, 12, 14} and -1 not in {r.doc_id for r in docs.collect()}
