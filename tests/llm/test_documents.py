"""Document operators on messy rows against brute force, on empty tables, and as stages."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

import messy
from fleetgrid.llm import components, deep_shallow, decontamination, exact_dedup, minhash, mixing, quality, secrets, shingles, suffix_dedup

KEY = lambda row: repr(row)


@pytest.fixture(scope="module")
def docs(spark):
    return messy.documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return messy.documents(spark, [])


def plain(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=KEY)


def test_exact_groups(docs):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    for d, t, *_ in messy.rows():
        groups[norm(t)].append(d)
    want = []
    for d, t, *_ in messy.rows():
        low = min((x for x in groups[norm(t)] if x is not None), default=None)
        want.append((d, low, len(groups[norm(t)]), d == low, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert plain(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=KEY)


def test_exact_stage_keeps_one_of_each_text(docs):
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    texts = Counter(re.sub(r"[\x20\x09-\x0d]+", " ", r.text or "") for r in kept.collect())
    assert set(texts.values()) == {1} and len(texts) == len({re.sub(r"[\x20\x09-\x0d]+", " ", r[1] or "") for r in messy.rows()})
    assert 1 in {r.doc_id for r in kept.collect()} and 2 not in {r.doc_id for r in kept.collect()}


def test_filter_misses_no_repeat(spark):
    # 300 digests in a single block of 32,768 bits
    df = spark.range(300).selectExpr("sha2(cast(id % 200 AS string), 256) AS d")
    marked = exact_dedup.with_suspects(df, "d", 300, exact_dedup.repeat_filter(exact_dedup.with_bits(df, "d", exact_dedup.block_count(300))))
    by = Counter(r.d for r in df.collect())
    assert all(r.suspect for r in marked.collect() if by[r.d] > 1)
    assert sum(not r.suspect for r in marked.collect() if by[r.d] == 1) > 80


def test_near_duplicates(docs):
    want = sorted(((d, n, c, d == c) for d, n, c in messy.near_components([r[:2] for r in messy.rows()])), key=KEY)
    assert plain(minhash.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == want


def test_near_duplicates_of_a_large_group(spark):
    # a base, copies that each change one or two places, and copies that drift away step by step
    base = messy.prose(20, 300).split()
    data = []
    for i in range(60):
        words = list(base)
        for k in range(1 + i % 3):
            words[(i * 17 + k * 71) % 300] = f"edit{i}x{k}"
        data.append((i, " ".join(words)))
    drift = messy.prose(21, 300).split()
    for i in range(60, 75):
        for k in range(3):
            drift[(i * 11 + k) % 300] = f"step{i}x{k}"
        data.append((i, " ".join(drift)))
    data += [(100 + i, messy.prose(30 + i, 200)) for i in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == {d: (n, c) for d, n, c in messy.near_components(data)}


def test_near_copies_from_another_threshold(spark):
    words = messy.prose(90, 300).split()
    other = [w if i % 60 != 30 else f"other{i}" for i, w in enumerate(words)]
    for i in (10, 100):
        other[i] = "more"
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    a, b = (messy.shingles(" ".join(w)) for w in (words, other))
    share = len(a & b) / len(a | b)
    assert 0.78 < share < 0.85
    for shared in (int(100 * share), int(100 * share) + 1, 85):
        assert minhash.keep_one(df, shared).count() == (1 if 100 * share >= shared else 2)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (3, 2)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_hashes_do_not_depend_on_blocks(monkeypatch):
    text = messy.prose(5, 500)
    whole = shingles.shingle_set(text)
    monkeypatch.setattr(shingles, "BLOCK", 37)
    assert (shingles.shingle_set(text) == whole).all() and len(whole) == len(messy.shingles(text))
    assert len(shingles.shingle_set("A b")) == 1 and (shingles.shingle_set("A b") == shingles.shingle_set("a\tB")).all()


def test_half_keys_meet_as_often_as_they_should():
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(200):
        s = rng.integers(0, 2**63, 1000, dtype=np.uint64)
        a, b = np.unique(s[:925]), np.unique(s[75:])  # similarity 0.85
        x, y = minhash.half_keys(a), minhash.half_keys(b)
        met += (x[:15] == y[:15]).any() and (x[15:] == y[15:]).any()
    assert met >= 199


def test_mixing_targets(docs):
    out = mixing.mix(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    sizes = Counter()
    for _, t, _, s, _ in messy.rows():
        sizes[s] += size(t)
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [5, 2, 1] * 9, strict=False))
    total, target = 1.5 * sum(sizes.values()), {}
    low, high = 0.0, total
    for _ in range(200):
        level = (low + high) / 2
        target = {s: min(2 * sizes[s], level * weights[s]) for s in sizes}
        low, high = (level, high) if sum(target.values()) < total else (low, level)
    taken = Counter()
    for r in out:
        assert math.isclose(r.target, target[r.source], abs_tol=1e-6) and r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(out) == len(messy.rows()) and all(abs(taken[s] - target[s]) <= 2 for s in sizes)
    assert sorted(out, key=KEY) == sorted(mixing.mix(docs.repartition(5)).collect(), key=KEY)


def test_mixing_stage_agrees_with_the_query(docs):
    took = plain(mixing.mix(docs).filter("taken > 0"), "doc_id", "size", "taken", "target")
    assert plain(mixing.mixed_documents(docs), "doc_id", "size", "taken", "target") == took


def test_water_filling_clamps_in_turn(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 40), ("d", 5), ("e", 0)], "source string, size long")
    out = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    assert out["a"] == 20 and out["d"] == 10 and out["e"] == 0 and math.isclose(sum(out.values()), 1.5 * 1055)


def brute_leaks(data, items):
    windows = lambda t: [tuple(w[i:i + 5]) for w in [re.findall(r"[^\W\d_]+", t.lower())] for i in range(max(1, len(w) - 4)) if w]
    found = set()
    for d, t in data:
        have = set(windows(t or ""))
        for i, x in items:
            want = windows(x or "")
            if want and sum(w in have for w in want) >= 0.8 * len(want):
                found.add((d, i))
    return found


def test_leaks_word_for_word(spark):
    data = [r[:2] for r in messy.rows()]
    item = messy.prose(50, 30)
    data += [(200, messy.prose(51, 40) + " " + item.upper() + " " + messy.prose(52, 40)), (201, messy.prose(53, 90)), (202, item.replace(" ", "\n"))]
    items = [(1, item), (2, messy.prose(54, 25)), (3, None), (4, ""), (5, "one two"), (5, "one two"), (None, messy.prose(10, 40))]
    df = messy.documents(spark, [(d, t, "en", "a", 1) for d, t in data])
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS id", "'h' AS hash", "2 AS doc_id")
    out = decontamination.leaks(df, bench)
    assert {(r.doc_id, r.item_id) for r in out.collect()} == brute_leaks(data, items) >= {(200, 1), (202, 1), (9, 5), (10, 5), (-1, None)}
    kept = decontamination.drop_leaking(df, bench)
    gone = {d for d, _ in brute_leaks(data, items)}
    assert kept.columns == df.columns and plain(kept, "doc_id") == sorted(((d,) for d, _ in data if d not in gone), key=KEY)


def test_leaks_with_other_numbers_and_names(spark):
    item = "A farmer named Alice has 12 apples and sells 5 kg of pears to Bob. How many apples does Alice have when 12 apples rot in the rain?"
    changed = item.replace("Alice", "Maria").replace("12", "7").replace("5 kg", "9 miles").replace("Bob", "Otto")
    broken = item.replace("Alice", "Maria", 1).replace("12", "7", 1).replace("Alice", "Otto").replace("12", "8").replace("Bob", "Eve").replace("5", "6")
    df = spark.createDataFrame([(1, item), (2, changed), (3, broken), (4, "A farmer has apples and sells pears.")], "doc_id long, text string")
    out = {r.doc_id: r.reparameterised for r in decontamination.leaks(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert out == {1: False, 2: True}


def leaked(spark, texts, items):
    out = decontamination.leaks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    return {(r.doc_id, r.item_id): r.reparameterised for r in out.collect()}


def test_leaks_of_an_item_dense_in_names(spark):
    item = "Alice has 5 apples. Bob has 3 apples. Carol has 7 apples. How many apples do they have?"
    changed = item.replace("Alice", "Maria").replace("Bob", "Otto").replace("Carol", "Eve")
    other = changed.replace("5", "9").replace("3", "4").replace("7", "8")
    crossed = item.replace("Alice", "Maria").replace("Bob", "Maria").replace("apples. How", "pears. How").replace("many apples", "many pears")
    # the names stand at the end, where a window can only grow to the left
    tail = "they sold all of the old apples to Alice 5 Bob 3 Carol 7"
    moved = "then " + tail.replace("Alice", "Maria").replace("Bob", "Otto").replace("Carol", "Eve") + " and Left it there"
    unlike = "Maria has 5 pears. Otto sold 3 plums. Eve ate 7 figs. How much fruit was there in the end?"
    got = leaked(spark, [item, f"{messy.prose(70, 9)} {changed} {messy.prose(71, 9)}", other, crossed, moved, unlike], [item, tail])
    assert got == {(0, 0): False, (1, 0): True, (2, 0): True, (4, 1): True}


def test_short_items_inside_longer_documents(spark):
    items = ["What causes ocean tides?", "one two", "What is 5 + 7?", "tides"]
    texts = [f"{messy.prose(80, 20)} what causes ocean tides {messy.prose(81, 20)}", "Who causes ocean tides", "Count 3 4 5 and one Two or so", "so what is 5 7", "What is 5 + 8?", "a ocean tides b"]
    assert leaked(spark, texts, items) == {(0, 0): False, (0, 3): False, (1, 0): True, (1, 3): False, (2, 1): False, (3, 2): False, (5, 3): False}


def test_cut_against_every_window(docs):
    data = [r[:2] for r in messy.rows()]
    want = sorted(messy.cut_texts(data), key=KEY)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert plain(suffix_dedup.cut(docs), *columns) == want
    # the same when every gram counts as crowded
    assert plain(suffix_dedup.cut(docs, hot_contexts=0), *columns) == want


def test_cut_at_the_length_of_a_match(spark):
    passage = messy.prose(90, 60)[:260]
    # 199 bytes are too few, 200 are enough, wherever the anchor lies in them
    rows = [(i, f"{messy.prose(200 + i, 30)}#{i}#{passage[at:at + size]}#{i}#{messy.prose(300 + i, 30)}")
            for i, (at, size) in enumerate([(0, 200), (1, 199), (1, 200), (30, 200), (60, 200), (0, 199), (5, 255)])]
    want = sorted(messy.cut_texts(rows), key=KEY)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain(suffix_dedup.cut(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_one_text_in_a_third_of_all_rows(spark):
    passage = messy.prose(91, 80)
    rows = [(None if i % 3 else i, passage) for i in range(400)] + [(1000 + i, f"{messy.prose(400 + i, 12)} {passage[i:i + 210]} {i}") for i in range(60)]
    want = sorted(messy.cut_texts(rows), key=KEY)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain(suffix_dedup.cut(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_a_common_context_is_sent_once(monkeypatch):
    passage = messy.prose(92, 80)
    frame = pd.DataFrame({"key": [b"k" * 16] * 500, "row": range(500), "text": [passage] * 500})
    every = np.full(1 << 13, 255, np.uint8).tobytes()
    sent = pd.concat(suffix_dedup._reader(every, 48, every, 48)([frame, frame]))
    assert len(sent) == sent["name"].nunique() == len(suffix_dedup.anchors(passage.encode())[0])


def test_deep_shallow_order():
    rng = np.random.default_rng(1)
    strings = rng.integers(97, 99, (400, 96), dtype=np.uint8)
    strings[:, :80] = strings[rng.integers(0, 5, 400), :80]
    strings[200:260] = strings[7]
    groups = rng.integers(0, 3, 400)
    order, shared = deep_shallow.sort(groups, strings)
    keys = [(groups[i], strings[i].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(400))
    for i in range(1, 400):
        same = keys[i][0] == keys[i - 1][0]
        assert shared[i] == (deep_shallow.mismatch(keys[i][1], keys[i - 1][1]) if same else -1)


def test_anchors_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    data = messy.prose(60, 400).encode()
    place, first, last, *_ = suffix_dedup.anchors(data)
    assert [s for a, b in zip(first, last, strict=True) for s in range(a, b + 1)] == list(range(len(data) - 199))
    assert all(a >= p - 136 and b <= p for p, a, b in zip(place, first, last, strict=True))


def test_quality_learns_and_survives(spark, docs):
    good = [(i, messy.prose(1000 + i, 60), "en", "a", 1) for i in range(400)]
    bad = [(1000 + i, " ".join(f"{w.upper()}!!" for w in messy.prose(3000 + i, 60).split()), "en", "a", 1) for i in range(300)]
    df = messy.documents(spark, good + bad + messy.rows())
    labels = spark.createDataFrame([(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in bad] + [(None, 1, 0), (5, None, 0), (0, 1, 1)], "doc_id long, quality int, toxic int")
    out = quality.quality_scores(df, labels)
    rows = out.collect()
    judged = [(r.predicted, int(r.doc_id < 1000)) for r in rows if r.held_out and r.doc_id is not None and (0 <= r.doc_id < 400 or r.doc_id >= 1000) and r.doc_id not in range(1, 20)]
    assert len(rows) == len(good + bad + messy.rows()) and np.mean([p == q for p, q in judged]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in rows)
    none = quality.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and len(none) == len(messy.rows())


def test_quality_weighs_agreed_training_ids_only(spark):
    data = [(i, messy.prose(1000 + i, 60).upper() if i % 3 == 0 else messy.prose(1000 + i, 60), "en", "a", 1) for i in range(240)]
    df, labels = messy.documents(spark, data), [(d, int(d % 3 > 0)) for d, *_ in data]
    held = [d for d, _ in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    more = [(held[0], 0)] * 300 + [(1, 1)] * 200 + [(20_000, 0), (20_000, 1)] + [(None, 0)] * 50
    weights = [quality.train(df, spark.createDataFrame(rows, "doc_id long, quality int")).weights for rows in (labels, labels + more)]
    assert weights[0] is not None and (weights[0] == weights[1]).all()


def test_secrets(spark):
    rng = np.random.default_rng(2)
    hexa = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    data = [(i, f"{messy.prose(i, 8)} password={hexa(18)} {messy.prose(i, 4)}", "en", "a", 1) for i in range(120)]
    data += [(200 + i, f"{messy.prose(i, 8)} order {rng.integers(10**15, 10**16)} {messy.prose(i, 4)}", "en", "b", 1) for i in range(120)]
    out = {r.doc_id: r for r in secrets.scan(messy.documents(spark, data + messy.rows())).collect()}
    assert len(out) == 240
    assert all(r.is_secret == (d < 200) and 0 <= r.score <= 1 for d, r in out.items())


def test_whole_values_of_secret_names(spark):
    text = """the password = "hunter2", pwd: Tr0ub4dor&3 and
 DB_PASSWORD='correct horse  battery' x?user=a&token=ab.cd-ef&auth=zyx {"api-key": "abcdefGHIJklmnopQRST"} passwd:=p@ss;w0rd! secret => a1B2c3D4e5F6g7H8i9.J1k2L3m4N5o6P7q8 end
 password=0123456789abcdef01 the secret of it, token: null, tokens = 3, author: Bob. auth: ''"""
    got = sorted((r.word, r.part, r.candidate, r.inside) for r in secrets.candidates(spark.createDataFrame([(1, text, "a"), (2, None, "a")], "doc_id long, text string, source string")).collect())
    words = re.split(r"\s+", text)
    assert [c for _, _, c, _ in got] == ["hunter2", "Tr0ub4dor&3", "correct horse  battery", "ab.cd-ef", "zyx", "abcdefGHIJklmnopQRST", "p@ss;w0rd!",
                                         "a1B2c3D4e5F6g7H8i9", "J1k2L3m4N5o6P7q8", "a1B2c3D4e5F6g7H8i9.J1k2L3m4N5o6P7q8", "0123456789abcdef01", "null"]
    assert all(c.split()[0] in words[w] for w, _, c, _ in got) and len({g[:2] for g in got}) == len(got)
    assert [n for *_, n in got if n] == ["password", "pwd", "password", "token", "auth", "api_key", "passwd", "secret", "password", "token"]
    data = [(i, f"{messy.prose(i, 8)} password = 'pw{i}!x' {messy.prose(i, 4)} token: null {messy.prose(i, 2)}", "en", "a", 1) for i in range(120)]
    found = secrets.scan(messy.documents(spark, data)).collect()
    assert len(found) == 240 and all(r.is_secret == (r.candidate != "null") for r in found)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (exact_dedup.exact_groups(empty), exact_dedup.drop_exact_copies(empty), minhash.near_duplicates(empty), minhash.keep_one(empty), mixing.mix(empty),
               mixing.mixed_documents(empty), decontamination.leaks(empty, bench), decontamination.drop_leaking(empty, bench), suffix_dedup.cut(empty),
               quality.quality_scores(empty, labels), quality.keep_good(empty, labels), secrets.scan(empty)):
        assert df.count() == 0


def test_leaks_of_rows_with_equal_or_no_ids(spark):
    item = "Alice Moore has 52 apples and buys 17 more apples at the market before lunch."
    other = "Peter Stone has 31 apples and buys 12 more apples at the market before lunch."
    clean = messy.prose(70, 60)
    bench = spark.createDataFrame([(1, item), (2, messy.prose(71, 40))], "item_id long, text string")
    for ids in ((1, 2, 3), (7, 7, 7), (None, None, None)):
        docs = spark.createDataFrame(list(zip(ids, (f"x {item} y", f"x {other} y", clean), strict=True)), "doc_id long, text string")
        assert sorted((r.item_id, r.reparameterised) for r in decontamination.leaks(docs, bench).collect()) == [(1, False), (1, True)]
        assert [r.text for r in decontamination.drop_leaking(docs, bench).collect()] == [clean]


def test_windows_that_all_items_share(spark):
    stem = "choose the best answer of the four that are given below and explain it "
    items = [(i, stem + messy.prose(1000 + i, 45)) for i in range(60)]
    docs = [(i, stem + messy.prose(3000 + i, 50)) for i in range(60)] + [(100 + i, items[i][1]) for i in range(5)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(d, b).collect()} == {(100 + i, i) for i in range(5)} == brute_leaks(docs, items)


def test_near_copies_without_ids(spark):
    text = messy.prose(80, 100)
    rows = [(1, text), (None, text + " more"), (None, messy.prose(81, 80)), (None, messy.prose(81, 80) + " end"), (2, text + " tail"), (2, messy.prose(82, 50)), (None, None), (3, "")]
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in kept if r.doc_id is not None), key=KEY) == [(1, text), (2, messy.prose(82, 50)), (3, "")]
    assert len([r for r in kept if r.doc_id is None]) == 2


def test_long_values_and_many_candidates(spark):
    long = "ab1" * 100_000
    escaped = '\\"' * 100_000
    many = " ".join(f"token=value{i}" for i in range(50_000))
    word = "&".join(f"auth=v{i}x" for i in range(3_000))
    rows = [(1, f'password="{long}" end', "a"), (2, f"secret='{escaped}'", "a"), (3, many, "a"), (4, word, "a"), (5, f'pwd="{long}', "a")]
    found = secrets.candidates(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5))
    by = Counter()
    for r in found.select("doc_id", "word", "candidate").collect():
        by[r.doc_id] += 1
        if r.doc_id == 3:
            assert r.candidate == f"value{r.word}"
    assert by == {1: 1, 2: 1, 3: 50_000, 4: 3_000, 5: 2}


def test_a_cloud_of_texts_around_the_threshold(spark):
    # 300 texts that are alike at 0.7 to 0.85, about half of them linked with some other
    base, rng, data = messy.prose(60, 150).split(), np.random.default_rng(8), []
    for i in range(300):
        words = list(base)
        for at in rng.choice(150, 2 + i % 3, replace=False):
            words[at] = f"w{i}x{at}"
        data.append((i, " ".join(words)))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()) == sorted(messy.near_components(data))


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, 20, dtype=np.uint64))))
        differ = sum(int(x).bit_count() for x in (minhash.parities(a) ^ minhash.parities(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and differ % 2 == len(np.setxor1d(a, b)) % 2


def sent(df):
    """The lines of the plan below each broadcast."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [re.search(r"\w|\*", x + "x").start() for x in lines]
    for i, x in enumerate(lines):
        if "BroadcastExchange" in x:
            yield [lines[j] for j in range(i + 1, next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines)))]


def test_hits_of_the_benchmark_never_travel(spark, monkeypatch):
    """Files of hits are a small part of their rows in memory, so no join may send them whole by the size of the files."""
    item = "Tom has 3 red apples and Mary gives him 4 more so how many apples does he have now"
    docs = spark.createDataFrame([(i, f"{i} said {item.replace('Tom', n)} and so on") for i, n in enumerate(["Tom", "Ann", "Bob"] * 20)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "A quite different question about the many rivers of the old world")], "item_id long, text string")
    limit, length = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    spark.conf.set("spark.sql.maxMetadataStringLength", "500")
    try:
        out = decontamination.leaks(docs, bench)
        below = list(sent(out))
        assert below and all("items-" in "".join(x) and "hits-" not in "".join(x) for x in below)
        want = plain(out, *out.columns)
        assert len(want) == 60
        # a benchmark too large to send does not travel either, whatever its files hold
        monkeypatch.setattr(decontamination, "MOST_SENT", 0)
        out = decontamination.leaks(docs, bench)
        assert not list(sent(out))
        assert plain(out, *out.columns) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.maxMetadataStringLength", length)
