"""A Merkle manifest of a dataset, and a proof of every row by pointer jumping.

Every row is a leaf.  The leaves of a source, by ``doc_id``, form a tree of
runs of ``WIDTH`` nodes; the subroots, by source, form the tree of the whole.
A run is one row that holds its children, so the leaves themselves meet in
groups of at most ``WIDTH``, whatever the size of their source.

Proofs are found by pointer jumping.  Every node above the leaves holds its
siblings as a segment that leads to its parent.  A round joins the nodes with
themselves: a node appends the segment of the ancestor that it points to and
takes over that ancestor's pointer, which doubles its distance.  After
``ceil(log2(height))`` rounds every node reaches the root.  The leaves are
attached to the finished paths of their runs, so no path is ever shuffled per
leaf.  What a round looks up are the nodes high enough to be pointed to at its
distance: with each round at least ``WIDTH`` times fewer.  They are broadcast
where their counted number bounds their size, else joined by shuffle.

Places in a source come from a range deal of the hashes (never of the texts),
numbered inside the parts and shifted by what earlier parts hold, so a source
that holds a third of all rows is spread like any other.

Defined cases: null fields are written as ``-``; a null ``doc_id`` comes last
in its source and is never tampered with; rows with equal ``doc_id`` follow
each other by their leaf; a null source is the first source; an empty table
gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import ascii_lower, global_rank, materialise

WIDTH = 16
TAMPER = 5  # divides the checksum of the ids that are tampered with
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SENT_BYTES = 32 << 20  # of looked-up nodes that are broadcast at most
TOP = -1  # number of the tree over the subroots


def _digest(data: Column) -> Column:
    return F.unhex(F.sha2(data, 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    """The digests as hex text, one after the other."""
    return F.array_join(F.transform(digests, _hex), "")


def field_text(value: Column) -> Column:
    """A field with its length in front, so that no two rows of fields read alike."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    fields = [text if name == "text" else F.col(name) for name in FIELDS]
    return _digest(F.concat(*map(field_text, fields)))


def leaves_of(docs: DataFrame) -> DataFrame:
    """doc_id, _source (empty for null, else after an ``s``), leaf, and tampered: the leaf of the tampered text, null for rows left alone."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    text = F.col("text").cast("string")
    # most rows are hashed once; of the others only those whose text changes are hashed again
    changed = hit & ~text.eqNullSafe(ascii_lower(text))
    return docs.select(
        F.col("doc_id"), F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("_source"),
        leaf_digest(text).alias("leaf"), F.when(changed, leaf_digest(ascii_lower(text))).alias("tampered"))


def _placed(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves with ``tree`` (rank of their source), ``place`` in it and ``leaves``; and (tree, _source, leaves)."""
    by = [F.col("_source").asc(), F.col("doc_id").asc_nulls_last(), F.col("leaf").asc()]
    dealt = materialise(leaves.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "leaves")
    # a row for each part and each source in it
    counts = materialise(dealt.groupBy("_source", "_part").agg(F.count("*").alias("n")), "counts")
    trees = materialise(global_rank(counts.groupBy("_source").agg(F.sum("n").alias("leaves")), "_source", "tree", "sources"), "trees")
    earlier = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_source", "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")).join(trees, "_source")
    # the stretch of a source in a part is no larger than the part: nothing here is dealt by source alone
    local = F.row_number().over(Window.partitionBy("_source", "_part").orderBy(*by[1:]))
    placed = dealt.withColumn("_local", local).join(starts, ["_source", "_part"])
    return placed.select("tree", "leaves", (F.col("_local") - 1 + F.col("_before")).cast("long").alias("place"), "doc_id", "leaf", "tampered"), trees


def _levels(leaves: int) -> int:
    """Levels of runs above that many leaves."""
    n = 0
    while leaves > 1:
        leaves, n = -(-leaves // WIDTH), n + 1
    return n


def _node(tree: Column, level: Column, place: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), place.cast("long").alias("place"))


def _subroot(tree: str = "tree") -> Column:
    """The id of a source's last node: a leaf of the tree over the sources."""
    return _node(F.lit(TOP), F.lit(0), F.col(tree))


def _climb(nodes: DataFrame, level: int) -> DataFrame:
    """The runs over nodes (tree, width, place, digest, height and more), each with its id and its children in order.

    ``width`` is the number of the tree's nodes in a level; ``height`` the longest way down to a node with a path.
    """
    place = F.floor(F.col("place") / WIDTH).cast("long")
    child = F.struct("place", *[c for c in nodes.columns if c not in ("tree", "width", "place")])
    runs = nodes.groupBy("tree", "width", place.alias("run")).agg(F.sort_array(F.collect_list(child)).alias("children"))
    inner = _node(F.col("tree"), F.lit(level), F.col("run"))
    last = (F.col("tree") != TOP) & (F.col("width") <= WIDTH)
    return runs.select(
        F.when(last, _subroot()).otherwise(inner).alias("id"), "tree", "width", F.col("run").alias("place"), "children",
        _digest(_joined(F.col("children.digest"))).alias("digest"), (F.array_max("children.height") + 1).alias("height"))


def _above(runs: DataFrame) -> DataFrame:
    """The runs as nodes of their level, where their tree has more than one of them."""
    width = F.ceil(F.col("width") / WIDTH).cast("long")
    return runs.filter(F.col("width") > WIDTH).select("tree", width.alias("width"), "place", "digest", "height")


def _siblings(digests: str, slot: str) -> Column:
    """The digests of a run before and after the one in a slot."""
    return F.struct(F.slice(digests, F.lit(1), F.col(slot)).alias("before"), F.slice(digests, F.col(slot) + 2, F.lit(WIDTH)).alias("after"))


def _segments(runs: DataFrame, level: int) -> DataFrame:
    """Every child of the runs, nodes of ``level``, as a node that points to its run with its siblings on the way."""
    slots = runs.select("id", "tree", F.col("children.digest").alias("all"), F.posexplode("children").alias("slot", "child"))
    return slots.select(
        _node(F.col("tree"), F.lit(level), F.col("child.place")).alias("id"), F.col("id").alias("up"), F.array(_siblings("all", "slot")).alias("path"),
        F.when((F.col("tree") == TOP) & (F.lit(level) == 0), F.col("child.digest")).alias("subroot"), F.col("child.height").alias("height"))


def _jumped(nodes: DataFrame, height: int) -> DataFrame:
    """The nodes with paths that end at the root, ``height`` steps above the lowest of them, and with their subroots."""
    current, distance = materialise(nodes, "paths"), 1
    while distance < height:
        # only a node with others this far below it is pointed to; nothing is known above the root
        high = current.filter(F.col("height") >= distance).select(*[F.col(c).alias(f"_{c}") for c in ("id", "up", "path", "subroot")])
        size = high.count() * (distance * WIDTH * 60 + 200)
        high = F.broadcast(high) if size <= SENT_BYTES else high
        path = F.when(F.col("_id").isNull(), F.col("path")).otherwise(F.concat("path", "_path"))
        current = materialise(current.join(high, F.col("up") == F.col("_id"), "left").select(
            "id", F.coalesce("_up", "up").alias("up"), path.alias("path"), F.coalesce("subroot", "_subroot").alias("subroot"), "height"), "paths")
        distance *= 2
    return current


def _folded(digest: Column, steps: Column) -> Column:
    """The digest at the end of a path, from the digest at its beginning and the siblings on it."""
    return F.aggregate(steps, digest, lambda d, s: _digest(F.concat(_joined(s["before"]), _hex(d), _joined(s["after"]))))


def _forest(leaves: DataFrame, longest: int) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """The lowest runs (a source's only row counts as one), the segments above them, and tree, digest and height of the subroots."""
    alone = F.col("width") == 1
    single = leaves.filter(alone).select(
        _subroot().alias("id"), "tree", "width", "place", F.array(F.struct("place", "digest", "height", "doc_id", "tampered")).alias("children"),
        "digest", F.lit(0).alias("height"))
    low = materialise(_climb(leaves.filter(~alone), 1).unionByName(single), "runs")
    last = lambda runs: runs.filter(F.col("width") <= WIDTH).select("tree", "digest", "height")
    runs, segments, done = low, [], last(low)
    for level in range(1, _levels(longest)):
        runs = materialise(_climb(_above(runs), level + 1), "runs")
        segments.append(_segments(runs, level))
        done = done.unionByName(last(runs))
    return low, segments, materialise(done, "subroots")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row, with ``proof``: the digests on its way to the root."""
    placed, trees = _placed(materialise(leaves_of(docs), "hashes"))
    longest, sources = trees.agg(F.coalesce(F.max("leaves"), F.lit(0)), F.count("*")).first()
    # leaves have no paths of their own: the lowest nodes that have one are their runs, at height 0
    leaves = placed.select("tree", F.col("leaves").alias("width"), "place", F.col("leaf").alias("digest"), F.lit(-1).alias("height"), "doc_id", "tampered")
    low, segments, top = _forest(leaves, longest)
    nodes = top.select(F.lit(TOP).cast("long").alias("tree"), F.lit(sources).cast("long").alias("width"), F.col("tree").alias("place"), "digest", "height")
    for level in range(_levels(sources)):
        runs = materialise(_climb(nodes, level + 1), "runs")
        segments.append(_segments(runs, level))
        nodes = runs.select("tree", F.ceil(F.col("width") / WIDTH).cast("long").alias("width"), "place", "digest", "height")
    root, height = nodes.select("digest", "height").first() or (b"", 0)

    known = None
    for part in segments:
        known = part if known is None else known.unionByName(part)
    steps = "array<struct<before:array<binary>,after:array<binary>>>"
    if known is None:  # no node but the root
        found = low.withColumns({"path": F.array().cast(steps), "subroot": F.lit(bytes(root))})
    else:
        paths = _jumped(known, height).select(F.col("id").alias("_id"), "path", "subroot")
        found = low.join(paths, F.col("id") == F.col("_id"), "left")
    return _proofs(found, bytes(root), steps)


def _proofs(found: DataFrame, root: bytes, steps: str) -> DataFrame:
    """The rows of the lowest runs with their proofs, from the paths of the runs."""
    rows = found.select(F.coalesce("path", F.array().cast(steps)).alias("path"), F.coalesce("subroot", F.lit(root)).alias("subroot"), "width",
                        F.col("children.digest").alias("all"), F.posexplode("children").alias("slot", "child"))
    whole = F.when(F.col("width") == 1, F.col("path")).otherwise(F.concat(F.array(_siblings("all", "slot")), F.col("path")))
    ways = rows.select("child.doc_id", "subroot", F.col("child.digest").alias("leaf"), F.coalesce("child.tampered", "child.digest").alias("seen"), whole.alias("steps"))
    proof = F.transform(F.flatten(F.transform("steps", lambda s: F.concat(s["before"], s["after"]))), _hex)
    ended = ways.withColumns({"proof": proof, "end": _folded(F.col("seen"), F.col("steps"))})
    return ended.select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.lit(root)).alias("root"),
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), _hex(F.col("end")).alias("folded_root"),
        (F.col("end") == F.lit(root)).alias("verified"), "proof")


def verified_rows(docs: DataFrame) -> DataFrame:
    """The digest columns of the manifest."""
    return manifest(docs).drop("proof")


def _sql_step(levels: str, seed: str, first: str) -> str:
    """A recursive table of a forest's nodes, level by level."""
    return f"""
    {levels} AS (
      SELECT tree, {first} AS level, place, digest, count(*) OVER (PARTITION BY tree) AS width FROM {seed}
      UNION ALL
      SELECT tree, level + 1, place // {WIDTH}, sha256(string_agg(digest, '' ORDER BY place)), (max(width) + {WIDTH - 1}) // {WIDTH}
      FROM {levels} WHERE width > 1 GROUP BY tree, level, place // {WIDTH})"""


def _sql_fold(name: str, seed: str, nodes: str) -> str:
    """A recursive table that leads rows (row, tree, place, digest, proof) of level 0 up their trees."""
    return f"""
    {name} AS (
      SELECT row, tree, 0 AS level, place, digest, proof FROM {seed}
      UNION ALL
      SELECT f.row, f.tree, f.level + 1, f.place // {WIDTH},
             sha256(string_agg(CASE WHEN n.place = f.place THEN f.digest ELSE n.digest END, '' ORDER BY n.place)),
             f.proof || coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place <> f.place), '')
      FROM {name} f JOIN {nodes} n ON n.tree = f.tree AND n.level = f.level AND n.place // {WIDTH} = f.place // {WIDTH} AND n.width > 1
      GROUP BY f.row, f.tree, f.level, f.place, f.digest, f.proof)"""


def _sql_field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _sql_leaf(text: str) -> str:
    return f"sha256({' || '.join(_sql_field(text if name == 'text' else name) for name in FIELDS)})"


# the checksum of the decimal digits, bit by bit
_SQL_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1))))"""

SQL = f"""
WITH RECURSIVE
    told AS (
      SELECT doc_id, {_sql_leaf('text')} AS leaf,
             CASE WHEN xor({_SQL_CRC}, 4294967295) % {TAMPER} = 0
                  THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered,
             dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, row_number() OVER () AS row
      FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf) - 1 AS place, leaf AS digest FROM told),
    {_sql_step('nodes', 'leaves', '0').strip()},
    subroots AS (SELECT 0 AS tree, tree AS place, digest FROM nodes WHERE width = 1),
    {_sql_step('top', 'subroots', '0').strip()},
    honest AS (SELECT row, tree, place, leaf AS digest, '' AS proof FROM leaves),
    forged AS (SELECT row, tree, place, coalesce(tampered, leaf) AS digest, '' AS proof FROM leaves),
    {_sql_fold('up', 'honest', 'nodes').strip()},
    {_sql_fold('up_forged', 'forged', 'nodes').strip()},
    below AS (SELECT row, max_by(digest, level) AS subroot, max_by(proof, level) AS proof FROM up GROUP BY row),
    below_forged AS (SELECT row, max_by(digest, level) AS digest FROM up_forged GROUP BY row),
    middle AS (SELECT l.row, 0 AS tree, l.tree AS place, b.subroot AS digest, b.proof FROM leaves l JOIN below b USING (row)),
    middle_forged AS (SELECT l.row, 0 AS tree, l.tree AS place, b.digest, '' AS proof FROM leaves l JOIN below_forged b USING (row)),
    {_sql_fold('over', 'middle', 'top').strip()},
    {_sql_fold('over_forged', 'middle_forged', 'top').strip()},
    ends AS (SELECT row, max_by(digest, level) AS root, max_by(proof, level) AS proof FROM over GROUP BY row),
    ends_forged AS (SELECT row, max_by(digest, level) AS folded_root FROM over_forged GROUP BY row)
SELECT doc_id, leaf, subroot, root, sha256(e.proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN below USING (row) JOIN ends e USING (row) JOIN ends_forged USING (row)
"""
