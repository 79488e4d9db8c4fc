"""Secret scan: candidates by shape, false positives removed by a random forest.

Only DataFrame operations and the DataFrame-based random forest. Candidates are cut out of white-space separated
words of the whole text, several a word. The forest sees the candidate's length, the transitions between its characters, how far words
of the corpus cover it, the path it comes from and the words next to it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.tables import materialize

SPACES = r"[\x20\x09-\x0D]+"
LEAST = 12  # characters of a piece that nothing next to it calls a secret
# A name and a sign, then the value: within quotes, or up to the next name and sign or the punctuation that ends the word.
# Runs are possessive and begin at their first character, so a word of any length is read once.
_ASSIGNED = (
    r"""(?s)(?<![A-Za-z0-9_.-])[0-9_.-]*+([A-Za-z][A-Za-z0-9_.-]*+)[\\"'\]]*+(?:=>|:=|=|:(?!//))[\\(\[{<]*+"""
    r"""(?:"([^"\\]++)|'([^'\\]++)"""
    r"""|((?:(?![&;,|]["']?[A-Za-z_][A-Za-z0-9_.-]*+["']?[=:]|[)\]}>.,;:\\]*+["'<>]|[)\]}>.,;:\\]++$).)++))"""
)
_ADDRESS = r"""://([^\s/:@"'<>]*+):([^\s/"'<>]+)@"""  # user and password
_PIECE = r"""[A-Za-z0-9](?:[A-Za-z0-9+/_-]|\.(?=[A-Za-z0-9_-])){11,}+(?:={1,2}(?![A-Za-z0-9=]))?"""
_BARE = r"""(?s)^["'`(\[{<]*+(.*?)["'`)\]}>.,;:]*$"""
DICTIONARY = 4096  # most frequent words of the corpus, at least three letters long
FIT_ROWS = 10_000  # labelled findings that the forest is fitted on, at most
TREES, DEPTH, SEED = 24, 6, 4
LIMIT = 0.5

# Names that announce a secret or another kind of number, words that mark examples, and published shapes of keys.
NAMES = r"(?i)(pass(words?|wd|phrase|code|key)?(?![a-z])|pwd|secret|token|api_?-?key|access_?-?key|private|auth(?!or)|bearer|credential)"
OTHER_NAMES = r"(?i)(sha\d*|md5|commit|revision|checksum|digest|uuid|guid|etag|hash|isbn|order|invoice|card|phone|tel)"
EXAMPLES = r"(?i)(?<![a-z])(examples?|samples?|tests?|dummy|fake|placeholder|changeme|docs?)(?![a-z])|xxxx|(?-i:EXAMPLE)"
SHAPES = (
    r"^AKIA[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36,}$", r"^xox[abprs]-[0-9A-Za-z-]{10,}$", r"^AIza[0-9A-Za-z_-]{35}$",
    r"^sk_live_[0-9A-Za-z]{16,}$", r"^eyJ[A-Za-z0-9_-]{10,}", r"^SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}$",
)
FEATURES = (
    "length", "turns", "digits", "capitals", "symbols", "hexadecimal", "grouped", "variety", "coverage", "vowels", "named", "named_before",
    "other_name", "assigned", "quoted", "example", "path_example", "path_depth", "code_near", "shape", "punctuation", "dots", "letters", "address", "runs",
)


def _is(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("double")


def _pairs(text: Column) -> Column:
    """(name, value) of all assignments in a text."""
    def all_of(group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(_ASSIGNED), F.lit(group))

    values = F.zip_with(F.zip_with(all_of(2), all_of(3), lambda a, b: F.concat(a, b)), all_of(4), lambda a, b: F.concat(a, b))
    return F.zip_with(all_of(1), values, lambda n, v: F.struct(n.alias("name"), v.alias("value")))


def _inner(pairs: Column) -> Column:
    """The assignments inside the values of assignments, such as the parameters of an address."""
    return F.flatten(F.transform(F.filter(pairs, lambda p: p["value"].rlike("[=:]")), lambda p: _pairs(p["value"])))


def candidates(documents: DataFrame) -> DataFrame:
    """(doc_id, source, place, name, value, kind, word, before, after): what may be a secret, several a word.

    Values of every length and kind that are assigned to a name (also within values, three deep), passwords in addresses,
    pieces of LEAST letters, digits and signs (dots inside included), and what follows a secret's name in words of its own.
    `place` counts words from 0; `before` and `after` are up to three words on either side.
    """
    words = documents.select("doc_id", F.col("source").cast("string").alias("source"), F.split("text", SPACES).alias("words"))
    # Each word gets its neighbours here and the words are dropped: a row per word must not carry all of them.
    places = {"before3": -3, "before2": -2, "before1": -1, "after1": 1, "after2": 2, "after3": 3}
    near = F.transform("words", lambda w, i: F.struct(w.alias("word"), *[F.get("words", i + k).alias(n) for n, k in places.items()]))
    each = words.select("doc_id", "source", F.posexplode(near).alias("place", "near")).select("doc_id", "source", "place", "near.*")
    last = F.col("before1")
    earlier = F.concat_ws(" ", "before3", "before2", "before1")
    told = F.coalesce((last.rlike("[=:>][\"']*$") | F.col("word").rlike("[0-9]")) & earlier.rlike(NAMES), F.lit(False))
    each = each.withColumn("told", told)
    likely = each.where((F.length("word") >= LEAST) | F.col("told") | F.col("word").rlike("[=:][^=:]"))
    outer = likely.withColumn("outer", F.when(F.col("word").rlike("[=:]"), _pairs(F.col("word"))).otherwise(F.array().cast("array<struct<name:string,value:string>>")))
    inner = outer.withColumn("inner", _inner(F.col("outer")))
    nested = inner.withColumn("assigned", F.concat("outer", "inner", _inner(F.col("inner"))))
    pieces = F.filter(
        F.regexp_extract_all("word", F.lit(_PIECE), F.lit(0)),
        # Neither a name of an assignment nor a part of a value.
        lambda x: ~F.exists(
            "assigned",
            lambda p: ((p["name"] == x) & ~x.rlike("[0-9]")) | (F.contains(p["value"], x) & ~F.contains(p["value"], F.lit("://"))),
        ),
    )
    users, passwords = (F.regexp_extract_all("word", F.lit(_ADDRESS), F.lit(k)) for k in (1, 2))
    bare = F.regexp_extract("word", _BARE, 1)
    alone = F.col("told") & (F.size("assigned") == 0) & (F.length(bare) < LEAST) & bare.rlike("[A-Za-z0-9]")

    def kind(name: str, value: Column, named: Column) -> Column:
        return F.struct(named.alias("name"), value.alias("value"), F.lit(name).alias("kind"))

    all_found = F.concat(
        F.transform("assigned", lambda p: kind("assigned", p["value"], p["name"])),
        F.zip_with(users, passwords, lambda u, v: kind("address", v, u)),
        F.transform(pieces, lambda x: kind("piece", x, F.lit(""))),
        F.when(alone, F.array(kind("told", bare, F.lit("")))).otherwise(F.array().cast("array<struct<name:string,value:string,kind:string>>")),
        # Other signs than those of pieces, after a secret's name.
        F.when(
            F.col("told") & (F.size("assigned") == 0) & (F.length(bare) >= LEAST) & ~F.array_contains(pieces, bare)
            & ~bare.rlike("://") & (~bare.rlike("^[A-Za-z0-9+/_.=-]+$") | (F.size(pieces) == 0)),
            F.array(kind("told", bare, F.lit(""))),
        ).otherwise(F.array().cast("array<struct<name:string,value:string,kind:string>>")),
    )
    found = nested.select(
        "doc_id", "source", "place", "word", F.explode(F.array_distinct(all_found)).alias("found"),
        earlier.alias("before"),
        F.concat_ws(" ", "after1", "after2", "after3").alias("after"),
    )
    return found.select("doc_id", "source", "place", "word", "found.*", "before", "after")


def dictionary(documents: DataFrame, size: int = DICTIONARY) -> DataFrame:
    """(piece): the most frequent lower-case words of three letters and more, counted over all documents."""
    words = documents.select(F.explode(F.split(F.lower("text"), SPACES)).alias("piece")).where("piece rlike '^\\\\p{L}{3,}$'")
    return words.groupBy("piece").count().orderBy(F.desc("count"), "piece").limit(size).select("piece")


def with_features(found: DataFrame, known: DataFrame) -> DataFrame:
    """The candidates with their FEATURES. `known` has at most DICTIONARY rows and is broadcast."""
    pieces = found.select("value").distinct()
    pieces = pieces.select("value", F.explode(F.expr("regexp_extract_all(lower(value), '[a-z]{3,}', 0)")).alias("piece"))
    covered = pieces.join(F.broadcast(known), "piece").groupBy("value").agg(F.sum(F.length("piece")).alias("covered"))
    n = F.length("value")

    def share(pattern: str) -> Column:
        return F.regexp_count("value", F.lit(pattern)) / n

    value, near = F.col("value"), F.concat_ws(" ", "before", "name")
    shape = F.lit(False)
    for pattern in SHAPES:
        shape |= value.rlike(pattern)
    return found.join(covered, "value", "left").withColumns({
        "length": F.least(n, F.lit(128)).cast("double"),
        "turns": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"),
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "symbols": share("[+/_=-]"),
        "hexadecimal": _is(value.rlike("^([0-9a-f]+|[0-9A-F]+)$") & value.rlike("[a-fA-F]")),
        "grouped": _is(value.rlike("^[0-9]+([-/_][0-9]+)*$|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")),
        "variety": F.size(F.array_distinct(F.split("value", ""))) / n,
        "coverage": F.coalesce(F.col("covered"), F.lit(0)) / n,
        "vowels": share("(?i)[aeiou]"),
        "named": _is(F.col("name").rlike(NAMES)),
        "named_before": _is(F.col("before").rlike(NAMES)),
        "other_name": _is(near.rlike(OTHER_NAMES)),
        "assigned": _is((F.col("name") != "") | F.col("before").rlike("[=:][^A-Za-z0-9]*$")),
        "quoted": _is(F.col("word").rlike("[\"']")),
        "example": _is(value.rlike(EXAMPLES) | F.concat_ws(" ", "before", "after").rlike(EXAMPLES)),
        "path_example": _is(F.col("source").rlike(EXAMPLES)),
        "path_depth": F.coalesce(F.least(F.regexp_count("source", F.lit("[/\\\\]")), F.lit(8)), F.lit(0)).cast("double"),
        "code_near": _is(F.concat_ws(" ", "before", "after").rlike("[{}();=<>]|//")),
        "shape": _is(shape),
        "punctuation": share("[^A-Za-z0-9+/_=.-]"),
        "dots": share("[.]"),
        "letters": _is(value.rlike("^[A-Za-z]+$")),
        "address": _is(F.col("kind") == "address"),
        "runs": F.length(F.array_join(F.regexp_extract_all("value", F.lit("[a-z]{4,}"), F.lit(0)), "")) / n,
    }).drop("covered")


def label_by_rules(featured: DataFrame) -> DataFrame:
    """Findings that are sure, with `label`: 1 for a published shape, a password in an address, or an assignment to a
    secret's name of a value that isn't an example (of letters only: eight or more in the name's own word); 0 for numbers in
    groups, values under another kind of name, and values that are words or runs of small letters. The rest is left out:
    the forest decides on it."""
    named = (F.col("named") == 1) | ((F.col("named_before") == 1) & (F.col("letters") == 0))
    strong = (F.col("letters") == 0) | (F.col("length") >= 8)
    secret = (F.col("shape") == 1) | (F.col("address") == 1) | ((F.col("assigned") == 1) & named & strong)
    other = (F.col("grouped") == 1) | (F.col("coverage") > 0.5) | ((F.col("other_name") == 1) & ~secret) | (F.col("example") == 1)
    other |= (F.col("runs") > 0.6) & ~secret
    label = F.when(other & (F.col("shape") == 0), 0).when(secret & (F.col("example") == 0), 1)
    return featured.withColumn("label", label).where("label is not null")


def fit(findings: DataFrame, rows: int = FIT_ROWS) -> RandomForestClassificationModel | None:
    """A forest fitted on labelled findings with FEATURES (at most `rows` of each label, by a hash of the value, so a secret
    repeated everywhere counts once). None where one label is missing."""
    once = findings.groupBy("value", "label").agg(*[F.max(f).alias(f) for f in FEATURES])
    drawn = [once.where(F.col("label") == v).orderBy(F.xxhash64(F.lit(SEED), "value"), "value").limit(rows) for v in (0, 1)]
    # One partition of a bounded sample in a fixed order: bagging gives the same trees in every run.
    sample = materialize(drawn[0].union(drawn[1]).repartition(1).sortWithinPartitions("value", "label"), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featureSubsetStrategy="sqrt")
    return forest.fit(ready.select("features", F.col("label").cast("double").alias("label")))


def scan(documents: DataFrame, findings: DataFrame | None = None, limit: float = LIMIT) -> DataFrame:
    """Accepted findings: doc_id, place (word, from 0), name, value_sha256, n_chars, probability.

    `findings` are labelled findings (value, label and FEATURES); without them the sure candidates of the documents are
    labelled by rules. Where one label is missing, no forest can be fitted: then sure findings are accepted with probability 1
    and nothing else. Null and empty texts hold no candidates; a null source is a path without features. Repeated rows are
    reported each. No rows give no rows. The value itself is not given out, only its hash.
    """
    known = materialize(dictionary(documents), "secret-words")
    featured = materialize(with_features(candidates(documents), known), "secret-candidates")
    labelled = findings if findings is not None else label_by_rules(featured)
    forest = fit(labelled)
    if forest is None:
        judged = label_by_rules(featured).where("label = 1").withColumn("chance", F.lit(1.0))
    else:
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured)
        judged = forest.transform(ready).withColumn("chance", F.get(vector_to_array("probability"), F.lit(1)))
    return judged.where(F.col("chance") >= limit).select(
        "doc_id", "place", F.nullif("name", F.lit("")).alias("name"), F.sha2("value", 256).alias("value_sha256"),
        F.length("value").alias("n_chars"), F.col("chance").alias("probability"),
    )
