"""Small tables with everything that may go wrong, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

CLASHING = ["key", "size", "hash", "_row", "class", "n", "kept", "target", "score", "label", "word", "path", "component_id", "taken", "_id", "digest", "b"]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(words))


def rows() -> list[tuple]:
    base, long = prose(1, 120), prose(2, 30_000)
    near = base.split()
    near[3] = "changed"
    shared = prose(3, 60)
    out = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "de", "b"), (4, None, None, None), (5, "", "en", "a"),
        (6, " \t\n ", "en", None), (7, long, "en", "b"), (8, long + " tail", "en", "b"), (None, base + " x", "en", "a"), (None, None, "en", "a"),
        (9, "one two", "en", "c"), (10, "One  TWO", "en", "c"), (11, prose(4, 50) + "\n" + shared + "\n" + prose(5, 50), "fr", "c"),
        (12, prose(6, 50) + "\n" + shared + "\n" + prose(7, 50), "fr", "c"), (13, base.replace(" ", "  "), "en", "a"), (14, "ÄÖ ß   x" * 3, "de", "d"),
        (15, "nul\x00byte and " + prose(8, 80), "en", "d"), (15, prose(9, 90), "en", "d"), (-1, prose(10, 40), "en", "e")]
    return [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in out]


def documents(spark, data=None):
    """The rows with extra columns whose names clash with what the operators use inside."""
    df = spark.createDataFrame(rows() if data is None else data, DOC_SCHEMA)
    for name in CLASHING:
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df.repartition(3)


def shingles(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_components(data) -> list[tuple]:
    """(doc_id, set size, component) of each (doc_id, text), by comparing everything with everything."""
    sets = [shingles(t) for _, t in data]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(data):
        ids = [d for k, (d, _) in enumerate(data) if find(k) == find(i) and d is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id))
    return out


def cut_texts(data, length: int = 200) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, sha) of each (doc_id, text), from a count of every window."""
    texts, seen = [(d, (t or "").encode()) for d, t in data], {}
    for _, b in texts:
        for i in range(len(b) - length + 1):
            w = hash(b[i:i + length])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d, b in texts:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[hash(b[i:i + length])] > 1:
                covered[i:i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        out.append((d, len(b), sum(covered), bytes(covered).replace(b"\0", b" ").decode("latin-1").split().__len__(), hashlib.sha256(kept).hexdigest()))
    return out


def cut_words(data, window: int = 13) -> list[tuple]:
    """(doc_id, n_words, n_removed, sha) of each (doc_id, text), from the smallest id of every window; null ids come last."""
    last, first = 1 << 63, {}
    texts = [(d, last if d is None else d, (t or "").encode().split()) for d, t in data]
    for _, at, words in texts:
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            first[key] = min(first.get(key, last), at)
    out = []
    for d, at, words in texts:
        covered = bytearray(len(words))
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < at:
                covered[i:i + window] = b"\1" * window
        kept = b" ".join(w for w, c in zip(words, covered, strict=True) if not c)
        out.append((d, len(words), sum(covered), hashlib.sha256(kept).hexdigest()))
    return out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def proofs(data) -> list[tuple]:
    """The manifest of (doc_id, source, lang, n_chars, text) rows with different ids, from whole trees in memory."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(field, r)))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees = {}
    for r in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, leaf(r))):
        trees.setdefault(r[1], []).append(r)

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    def climb(tree, place, digest, proof):
        for nodes in tree[:-1]:
            lo = place // 16 * 16
            others = nodes[lo:place] + nodes[place + 1:lo + 16]
            digest = sha("".join(nodes[lo:place]) + digest + "".join(nodes[place + 1:lo + 16]))
            proof, place = proof + "".join(others), place // 16
        return digest, proof

    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels([leaf(r) for r in trees[s]]) for s in order}
    top = levels([built[s][-1][0] for s in order])
    out = []
    for number, s in enumerate(order):
        for place, r in enumerate(trees[s]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            forged = leaf((*r[:4], r[4].translate(lower))) if hit else leaf(r)
            sub, proof = climb(built[s], place, leaf(r), "")
            root, proof = climb(top, number, sub, proof)
            folded = climb(top, number, climb(built[s], place, forged, "")[0], "")[0]
            assert sub == built[s][-1][0] and root == top[-1][0]
            out.append((r[0], leaf(r), sub, root, sha(proof), folded, folded == root))
    return out


def negatives(data) -> list[tuple]:
    """The hard negatives of (vec_id, vector, label) rows with different ids, from all inner products."""
    used = []
    for i, v, label in data:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, va, la in used:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in used if i != a)
        for p, pid, _ in [s for s in scored if s[2] == la][:5]:
            hard = [(-s, i) for s, i, label in scored if label != la and 30 * -p <= 100 * -s <= 90 * -p]
            out += [(a, pid, rank, i, -p, s) for rank, (s, i) in enumerate(hard[:10], 1)]
    return out
