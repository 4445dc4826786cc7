"""Secret scans: candidate strings, and a random forest that removes false positives.

Candidates are runs of at least ``SHORTEST`` characters of ``[A-Za-z0-9+/_-]`` with a digit, anywhere in
a text, and the whole values that are assigned to a secret's name, of any length
and characters.  Each is described by its length, the shares of its character classes,
the transitions between those classes, how much of it dictionary words cover,
how often findings on its path (the document's source) and next to its
neighbouring words were secrets, and a forest trained on labelled findings
scores it.  The dictionary is what the corpus itself uses: words
that stand alone at least ``DICTIONARY_USES`` times in all documents.

All of it is DataFrame operations and the JVM's own forest; the forest learns
from at most ``TRAINING_ROWS`` findings of each class, in the order of a
fixed hash.  Candidates are few, so only their rows are ever shuffled; counts by path and
word are combined before the shuffle.

Defined cases: null and empty texts have no candidates; a null source is a
path of its own; repeated rows give repeated findings; very long texts, values and
words are searched whole; findings without labels of both classes all score 0.5; an empty table gives an empty result; other
columns are never looked at.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .tables import SPACES, materialise, text_of

SHORTEST = 16
DICTIONARY_USES = 5
TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 24, 6, 7
BLOCK = 256  # counts that are summed up together
ACCEPT = 0.5
RUN = r"[A-Za-z0-9+/_\-]"
CANDIDATE = rf"(?<!{RUN})(?=[A-Za-z+/_\-]*[0-9]){RUN}{{{SHORTEST},}}"
CLASSES = "aA0-"
TRANSITIONS = [x + y for x in CLASSES for y in CLASSES]
NEIGHBOURS = ("before", "before2", "inside")
FEATURES = ["length", "digits", "upper", "distinct", "coverage", "path_rate", *[f"{n}_rate" for n in NEIGHBOURS], *[f"t{i}" for i in range(len(TRANSITIONS))]]

# What marks a finding of the registered query as a secret: published key formats and names that secrets are assigned to.
KEY_FORMAT = r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$"
SECRET_NAMES = "password passwd pwd secret token apikey api_key access_key auth".split()
# What stands where a value would: no secret, though assigned to a secret's name.
PLACEHOLDER = r"(?i)^(?:true|false|null|nil|none|undefined|required|optional|string|yes|no|n/a|changeme|redacted|\W+|x+|\$\{.*|\{\{.*|\{\w*\}|<.*>|\[\w*\]|%\w|\$\w+|[\w.]+\(.*|(?:os|process)\.\w+.*)$"
# A secret's name, also as the end of a longer name, what assigns, and a value: quoted, or up to a blank or the next assignment.
NAME = r"(?i)(?<![a-z])(password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)"
ASSIGNS = NAME + r"\\?[\"']?\s*(?::=|=>|={1,2}|:)\s*"
ASSIGNED = ASSIGNS + (
    # possessive: a long value is not matched step by step on the stack
    r"(?:\"((?:[^\"\\\n]++|\\.)++)\"|'((?:[^'\\\n]++|\\.)++)'|`([^`\n]++)`|"
    r"((?!\"\"|'')(?:(?![&,;][\"']?[A-Za-z_][\w.-]*[\"']?[=:])\S)+))")


def plain_word(word: Column) -> Column:
    """A word's letters and underscores in lower case."""
    return F.lower(F.regexp_replace(F.coalesce(word, F.lit("")), r"[^A-Za-z_]+", ""))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(counts: Column, sums: Column, place: Column) -> Column:
    """The sum of the counts before a place, from the sums of whole blocks of them."""
    blocks = F.floor(place / BLOCK).cast("int")
    add = lambda total, x: total + x
    return F.aggregate(F.slice(sums, F.lit(1), blocks), F.lit(0), add) + F.aggregate(F.slice(counts, blocks * BLOCK + 1, place - blocks * BLOCK), F.lit(0), add)


def _assignments(text: Column) -> Column:
    """number, found, word (where the value begins), whether it is a run of that word and how many that has, and the words before it."""
    blanks = lambda c: F.regexp_count(c, F.lit(SPACES))
    read = F.struct(F.split(text, SPACES).alias("words"), F.regexp_extract_all(text, F.lit(ASSIGNED), 0).alias("all"), F.split(text, ASSIGNED, -1).alias("between"))

    def counted(s):
        # the text between assignments and the assignments alternate; blanks before a value tell its word
        steps = F.zip_with(F.slice(s["between"], F.lit(1), F.size(s["all"])), s["all"], lambda b, a: F.struct(
            blanks(b).alias("before"), blanks(F.regexp_extract(a, ASSIGNS, 0)).alias("own"), blanks(a).alias("all")))
        return F.struct(s["words"].alias("words"), F.transform(s["words"], lambda w: F.regexp_extract_all(w, F.lit(CANDIDATE), 0)).alias("runs"),
                        s["all"].alias("all"), steps.alias("steps"), F.transform(steps, lambda c: c["before"] + c["all"]).alias("counts"))

    def summed(s):
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(s["counts"]) / BLOCK).cast("int")), lambda b: F.aggregate(
            F.slice(s["counts"], b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda total, x: total + x))
        return s.withField("sums", blocks)

    def placed(s):
        def one(found, number):
            step = F.get(s["steps"], number)
            at = _before(s["counts"], s["sums"], number) + step["before"] + step["own"]
            return _let(at, lambda word: F.struct(
                number.alias("number"), found.alias("found"), word.alias("word"), F.get(s["runs"], word).alias("runs"),
                plain_word(F.get(s["words"], word - 1)).alias("before"), plain_word(F.get(s["words"], word - 2)).alias("before2")))

        def told(a):
            value = value_of(a["found"])
            return F.struct(a["number"].alias("number"), a["word"].alias("word"), value.alias("candidate"), F.array_contains(a["runs"], value).alias("known"),
                            F.size(a["runs"]).alias("runs"), a["before"].alias("before"), a["before2"].alias("before2"),
                            F.translate(F.lower(F.regexp_extract(a["found"], ASSIGNED, 1)), "-", "_").alias("inside"))

        return F.transform(s["all"], lambda found, number: _let(one(found, number), told))

    return _let(_let(_let(read, counted), summed), placed)


def value_of(found: Column) -> Column:
    """The value of an assignment, without its quotes or the sign that ends its sentence."""
    bare = F.regexp_replace(F.regexp_extract(found, ASSIGNED, 5), r"(?<=.)[.,;]+$", "")
    return F.concat(*[F.regexp_extract(found, ASSIGNED, k) for k in (2, 3, 4)], bare)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, path, word (its number), part, candidate and its neighbouring words.

    A run's ``part`` counts the runs of its word; values that are no run of the
    word where they begin are numbered on from there, in the order of the text.
    What a candidate needs of its text is picked before rows are made of the
    candidates, so no row carries the text.
    """
    read = docs.select("doc_id", F.col("source").cast("string").alias("path"), text_of().alias("text"))

    def near(words, i):
        word = F.get(words, i)
        return F.struct(
            i.alias("word"), F.regexp_extract_all(word, F.lit(CANDIDATE), 0).alias("runs"), plain_word(F.get(words, i - 1)).alias("before"),
            plain_word(F.get(words, i - 2)).alias("before2"), plain_word(F.regexp_extract(word, r"^[^A-Za-z]*([A-Za-z_]+)[=:]", 1)).alias("inside"))

    places = _let(F.split("text", SPACES), lambda words: F.filter(
        F.transform(words, lambda w, i: F.when(w.rlike(CANDIDATE), near(words, i))), lambda x: x.isNotNull()))
    placed = read.filter(F.col("text").rlike(CANDIDATE)).select("doc_id", "path", F.explode(places).alias("at"))
    runs = placed.select("doc_id", "path", "at.word", F.posexplode("at.runs").alias("part", "candidate"), "at.before", "at.before2", "at.inside")

    valued = read.filter(F.col("text").rlike(ASSIGNED)).select("doc_id", "path", F.explode(_assignments(F.col("text"))).alias("at")).filter("NOT at.known")
    values = valued.select("doc_id", "path", "at.word", (F.col("at.runs") + F.col("at.number")).alias("part"), "at.candidate", "at.before", "at.before2", "at.inside")
    return runs.unionByName(values)


def letters_of(candidate: Column) -> Column:
    return F.regexp_extract_all(F.lower(candidate), F.lit("[a-z]{4,}"), 0)


def dictionary_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Those letter runs of the candidates that are words of the corpus."""
    runs = found.select(F.explode(letters_of(F.col("candidate"))).alias("run")).distinct()
    words = docs.select(F.explode(F.split(F.lower(text_of()), "[^a-z]+")).alias("run")).filter(F.length("run") >= 4)
    return words.join(runs, "run").groupBy("run").agg(F.count("*").alias("uses")).filter(F.col("uses") >= DICTIONARY_USES).select("run")


def described(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Adds the features that a candidate has by itself."""
    c = F.col("candidate")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    size = F.length(c).cast("double")
    shares = {"length": size, "digits": F.regexp_count(c, F.lit("[0-9]")) / size, "upper": F.regexp_count(c, F.lit("[A-Z]")) / size,
              "distinct": F.size(F.array_distinct(F.split(c, ""))) / size}
    steps = {f"t{i}": F.regexp_count("shape", F.lit(f"{t[0]}(?={t[1]})")) / size for i, t in enumerate(TRANSITIONS)}
    by_candidate = found.select("candidate").distinct()
    covered = by_candidate.select("candidate", F.explode(letters_of(c)).alias("run")).join(dictionary, "run").groupBy("candidate").agg(
        F.sum(F.length("run")).alias("letters"))
    return found.join(covered, "candidate", "left").withColumn("coverage", F.coalesce("letters", F.lit(0)) / size).drop("letters").withColumn(
        "shape", shape).withColumns({**shares, **steps}).drop("shape")


def with_rate(rows: DataFrame, labelled: DataFrame, column: str, rate: str) -> DataFrame:
    """Adds how often labelled findings with the same value were secrets, smoothed; 0.5 for values never seen.

    In the labelled rows themselves the row's own label is left out.
    """
    counts = labelled.groupBy(F.col(column).alias("_value")).agg(F.sum("label").alias("_yes"), F.count("*").alias("_all"))
    own = F.coalesce(F.col("label"), F.lit(0)) if "label" in rows.columns else F.lit(0)
    seen = F.col("label").isNotNull().cast("int") if "label" in rows.columns else F.lit(0)
    value = (F.coalesce("_yes", F.lit(0)) - own + 1) / (F.coalesce("_all", F.lit(0)) - seen + 2)
    return rows.join(counts, F.col(column).eqNullSafe(F.col("_value")), "left").withColumn(rate, value).drop("_value", "_yes", "_all")


def score_findings(found: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, word, part, candidate, score and is_secret of findings whose ``label`` is 0, 1 or null (unknown)."""
    full = materialise(described(found, dictionary_of(docs, found)), "described")
    labelled = full.filter("label IS NOT NULL").select("path", *NEIGHBOURS, "label")
    for column in ("path", *NEIGHBOURS):
        full = with_rate(full, labelled, column, f"{column}_rate")
    rated = materialise(full, "rated")
    order = [F.md5(F.concat_ws(":", "doc_id", "word", "part")), "doc_id", "word", "part", "candidate"]
    sample = [rated.filter(F.col("label") == k).orderBy(*order).limit(TRAINING_ROWS) for k in (0, 1)]
    sample = materialise(sample[0].unionByName(sample[1]), "findings")
    columns = ["doc_id", "word", "part", "candidate"]
    if sample.select("label").distinct().count() < 2:
        return rated.select(*columns, F.lit(0.5).alias("score"), F.lit(True).alias("is_secret"))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="_label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
        numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    model = forest.fit(vectors.transform(sample.withColumn("_label", F.col("label").cast("double"))))
    scored = model.transform(vectors.transform(rated)).withColumn("score", vector_to_array("_probability")[1])
    return scored.select(*columns, "score", (F.col("score") >= ACCEPT).alias("is_secret"))


def rule_label() -> Column:
    """1 for published key formats and values assigned to a secret's name, but for placeholders, else 0."""
    named = F.lit(False)
    for column in NEIGHBOURS:
        named = named | F.col(column).isin(SECRET_NAMES)
    return F.when(F.col("candidate").rlike(KEY_FORMAT) | named & ~F.col("candidate").rlike(PLACEHOLDER), 1).otherwise(0)


def scan(docs: DataFrame) -> DataFrame:
    """Scored findings of all documents; the labels are rules on three quarters of the ids, the rest is judged unseen."""
    found = candidates(docs)
    learnt = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    return score_findings(materialise(found.withColumn("label", F.when(learnt, rule_label())), "found"), docs)
