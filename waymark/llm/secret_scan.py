"""Secret scans: candidates by shape, false positives removed by a random forest.

A candidate is a run of sixteen or more letters, digits and signs that keys are
written in, or a shorter value of any signs that is quoted, assigned to a name
or sent in an authorization header. The forest sees its length, how often
neighbouring characters change class, how usual its letter pairs are, how much
of it a word list covers, the path it comes from and the words and signs around
it. It is trained on labelled findings, each once as it stands and once without
the name it is assigned to and its quotes. Where a name labels the findings, the
forest so has to learn what keys look like, finds keys without a name, and lets
go of named values that look like none.

Everything here is DataFrame and SQL functions and ``pyspark.ml``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.text import least_hashed
from waymark.session import written

#: Names that a secret is assigned to; a number or a part after a sign may follow, as in token2 or api_key-prod.
NAMES = "token|secret|passwd|password|passphrase|pwd|api_?key|access_?key|private_?key|client_?secret|credentials?|authorization|auth"
SCHEMES = "bearer|basic|token|digest|apikey"
_SUFFIX = r"(?:[_0-9-][A-Za-z0-9_-]{0,16})?"
# Java's lookbehind needs bounds. Cheap ones come first, as they are tried at each place of a text.
_SIGN = r"[\"'`]?[ \t]{0,4}[=:]{1,2}>?[ \t]{0,4}"
_NAMED = rf"(?i:{NAMES}){_SUFFIX}{_SIGN}"
_NO_SCHEME = rf"(?!(?i:{SCHEMES})[ \t])"
_QUOTED = "|".join(
    rf"(?<={_NAMED}{q}){_NO_SCHEME}(?=[^{q}\r\n]{{4}})[^{q}\\\r\n]*+(?:\\.[^{q}\\\r\n]*+)*+(?={q})|(?<={q})[^\s{q}]{{8,}}+(?={q})" for q in "\"'`")
_FREE = r"[^\s\"'`]*[^\s\"'`.,;:)\]}>]"
_ASSIGNED = rf"(?<={_NAMED}){_NO_SCHEME}(?![=:>])(?=[^\s\"'`]{{4}}){_FREE}|(?<=[\p{{L}}0-9_\])]{_SIGN})(?![=:>/])(?=[^\s\"'`]{{8}}){_FREE}"
_HEADER = rf"(?<=(?i:authorization){_SIGN}[\"'`]?(?i:{SCHEMES})[ \t]{{1,4}})(?=[^\s\"'`]{{8}}){_FREE}"
_WEB_TOKEN = r"eyJ[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]{4,}+){1,2}"
# '=' belongs to a run as padding alone; before a value it is an assignment.
_PADDING = r"(?:==(?![=A-Za-z0-9+/_\"'`-])|=(?![ \t]{0,4}[^\s,;.)\]}]))?"
_RUN = rf"(?=[+/_-]*+[A-Za-z0-9])[A-Za-z0-9+/_-]{{16,}}+{_PADDING}"
CANDIDATE = (
    rf"(?<=[\"'`])(?:{_QUOTED})|(?<=[=:> \t])(?<=[=:>][ \t]{{0,4}})(?:{_ASSIGNED})|(?<=[ \t])(?<=[rcntyRCNTY][ \t]{{1,4}})(?:{_HEADER})"
    rf"|(?<![A-Za-z0-9+/_-])(?:{_WEB_TOKEN}|{_RUN})")
#: Characters of text on either side that the forest looks at.
CONTEXT = 48
MASK = "<SECRET>"
#: A word is one of so many buckets to the forest; the first is for none.
BUCKETS = 64
FEATURES = (
    "length", "class_changes", "distinct_share", "digit_share", "capital_share", "small_share", "hexadecimal", "pair_usualness", "coverage",
    "path_bucket", "assigned", "quoted", "name_bucket", "before_bucket", "after_bucket", "before_digits",
)
_ASSIGNMENT = r"([\p{L}0-9_.-]*)[\"'`]?\s*[=:]+>?\s*[\"'`]?$"
#: Values that stand where a secret should be put in, and words that announce a digest or a version.
PLACEHOLDERS = (
    r"(?i)^[<\[{(]?(your|my|insert|enter|change|replace|put)([_ .-].*|me|this)$|^(.)\3{3,}$"
    r"|^(placeholder|dummy|todo|none|null|redacted|undefined|example|sample)([_ .-](token|key|secret|password|value|here))*[>\]})]?$")
DIGESTS = r"(?i)\b(commit|revision|sha-?(1|256|512)|md5|checksum|etag|uuid|guid)[^\p{L}0-9]{0,4}$"


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, text_key, path, place (from 0), start (code points), value, before, after.

    Rows equal in doc_id and text are scanned once. A null text has none. The
    path is ``source``, null where the table has no such column.
    """
    path = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    hit = docs.select("doc_id", "text", path.alias("path"), F.xxhash64("text").alias("text_key")).filter(F.col("text").rlike(CANDIDATE))
    cut = hit.select(
        "doc_id", "text_key", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("values"), F.split("text", CANDIDATE, -1).alias("parts"))
    # A long name is a run of its own; the value assigned to it still has to see it.
    last = lambda c: F.substring(F.coalesce(c, F.lit("")), -CONTEXT, CONTEXT)
    each = F.transform("values", lambda v, i: F.struct(
        v.alias("value"), last(F.concat(last(F.get("values", i - 1)), last(F.get("parts", i)))).alias("before"), F.substring(F.get("parts", i + 1), 1, CONTEXT).alias("after"),
        F.char_length(F.get("parts", i)).cast("long").alias("gap")))
    rows = cut.select("doc_id", "text_key", "path", F.posexplode(each).alias("place", "c")).select("doc_id", "text_key", "path", "place", "c.*").dropDuplicates(["doc_id", "text_key", "place"])
    sofar = Window.partitionBy("doc_id", "text_key").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum(F.col("gap") + F.char_length("value")).over(sofar) - F.char_length("value")
    return rows.withColumn("start", start).drop("gap")


@dataclass(frozen=True)
class Dictionary:
    """Usual words, and the logarithm of each letter pair's share; counted over all texts."""

    words: tuple[str, ...] = ()
    pairs: dict[str, float] = field(default_factory=dict)


def learn_dictionary(docs: DataFrame, share: float = 1e-4) -> Dictionary:
    """Counts the words of all texts, whole and in any language, and the letter pairs in them.

    The list holds words of at least ``share`` of all words, so at most 1 / share.
    Pairs of a to z are all kept; of other pairs those of at least ``share``.
    """
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}]{3,}"), F.lit(0)))
    seen = written(docs.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n")), "words")
    n_words = seen.agg(F.sum("n")).first()[0] or 1
    usual = [r["word"] for r in seen.filter(F.col("n") >= share * n_words).select("word").collect()]
    # Letters as a list: counting to a place in a very long word again for each pair would take the square of its length.
    letters = seen.select("n", F.regexp_extract_all("word", F.lit("."), F.lit(0)).alias("letters"))
    two = F.zip_with(F.slice("letters", F.lit(1), F.size("letters") - 1), F.slice("letters", F.lit(2), F.size("letters") - 1), lambda x, y: F.concat(x, y))
    counts = written(letters.select("n", F.explode(two).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    n_pairs = counts.agg(F.sum("n")).first()[0] or 1
    kept = counts.filter(F.col("pair").rlike("^[a-z]{2}$") | (F.col("n") >= share * n_pairs)).collect()  # at most 26 * 26 and 1 / share
    return Dictionary(tuple(sorted(usual)), {r["pair"]: math.log(r["n"] / n_pairs) for r in sorted(kept)})


def _bucket(word: Column) -> Column:
    return F.when(word == "", 0).otherwise(1 + F.pmod(F.xxhash64(F.lower(word)), F.lit(BUCKETS - 1)))


def described(found: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Adds the columns of ``FEATURES`` to candidates."""
    value, size = F.col("value"), F.char_length("value")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / size
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "[^aA0]", "-")
    low = F.lower(value)
    if dictionary.pairs:
        usual = F.create_map(*(F.lit(x) for kv in dictionary.pairs.items() for x in kv))
        rare = F.lit(min(dictionary.pairs.values()) - 1)
        total = F.aggregate(F.sequence(F.lit(1), size - 1), F.lit(0.0), lambda s, i: s + F.coalesce(F.element_at(usual, low.substr(i, F.lit(2))), rare))
        usualness = total / (size - 1)
    else:
        usualness = F.lit(0.0)
    # Longer words first, as the first alternative that fits is taken.
    listed = "|".join(sorted(dictionary.words, key=lambda w: (-len(w), w)))
    coverage = 1 - F.char_length(F.regexp_replace(low, listed, "")) / size if listed else F.lit(0.0)
    word_before, word_after = F.regexp_extract(F.regexp_replace("before", _ASSIGNMENT, ""), r"([\p{L}0-9]+)[^\p{L}0-9]*$", 1), F.regexp_extract("after", r"^[^\p{L}0-9]*([\p{L}0-9]+)", 1)
    columns = {
        "length": size, "class_changes": (F.char_length(F.regexp_replace(shape, r"(.)\1+", "$1")) - 1) / (size - 1),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / size, "digit_share": share("[0-9]"), "capital_share": share("[A-Z]"), "small_share": share("[a-z]"),
        "hexadecimal": value.rlike("^[0-9a-fA-F]+$"), "pair_usualness": usualness, "coverage": coverage,
        "path_bucket": _bucket(F.coalesce("path", F.lit(""))), "assigned": F.col("before").rlike(_ASSIGNMENT), "quoted": F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]"),
        "name_bucket": _bucket(F.regexp_extract("before", _ASSIGNMENT, 1)), "before_bucket": _bucket(word_before), "after_bucket": _bucket(word_after),
        "before_digits": F.regexp_count(word_before, F.lit("[0-9]")) / F.greatest(F.char_length(word_before), F.lit(1)),
    }
    return found.withColumns({name: columns[name].cast("double") for name in FEATURES})


#: How keys of well-known services begin.
PREFIXES = (
    r"^((AKIA|ASIA)[0-9A-Z]{12}|gh[pousr]_|github_pat_|glpat-|xox[abeoprs]-|sk[-_](?=.*[0-9A-Z])|[rp]k_(live|test)_|AIza|ya29\.|eyJ|npm_|pypi-|hf_|SG\.|shp(at|ss)_)")


def _assigned_to(names: str) -> Column:
    return F.col("before").rlike(rf"(?i)({names}){_SUFFIX}[\"'`]?\s*[=:]+>?\s*[\"'`]?$")


def _named() -> Column:
    """Whether the signs around a value, or those it begins with, are a secret's."""
    value, quoted = F.col("value"), F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")
    # A word in prose after "password:" isn't one, nor is a call or a variable.
    keyed = (value.rlike(r"[0-9!$&@#%^*?+/=~]|[a-z][A-Z]") | (F.char_length("value") >= 16)) & ~value.rlike(r"^(\$[{(]|<|\{\{|%[{(])|\($")
    header = F.col("before").rlike(rf"(?i)authorization[\"'`]?\s*[=:]+\s*[\"'`]?({SCHEMES})\s+$") | F.col("before").rlike(r"(?i)\bbearer\s+$") & keyed
    return _assigned_to(NAMES) & (quoted | keyed) | header | value.rlike(PREFIXES)


def labelled_by_name(found: DataFrame) -> DataFrame:
    """Labels candidates where nobody has looked at findings.

    A secret is a value assigned to one of ``NAMES`` that is quoted or looks
    like a key, one in an authorization header, and one that begins like a known
    key. None is a placeholder, a run that is neither assigned nor quoted, and a
    lone word or number assigned to a name without a hint of keys. The rest get
    null, and so do long hexadecimal runs by themselves, unless announced as a
    digest, for they may be either.
    """
    before = F.col("before")
    alone = ~before.rlike(r"[=:]>?\s*[\"'`]?$") & ~before.rlike("[\"'`]$") & ~before.rlike(r"(?i)\bbearer\s+$")
    usual = before.rlike(r"[=:]>?\s*$") & ~_assigned_to(rf"{NAMES}|key|pass|pin|cred|sig") & F.col("value").rlike(r"^(\p{L}\p{Ll}{0,14}|\p{Lu}{1,15}|[0-9.,:/-]{1,15})\p{P}*$")
    placeholder, digest = F.col("value").rlike(PLACEHOLDERS), before.rlike(DIGESTS)
    open_ = F.col("value").rlike(r"^(?=.*[0-9])(?=.*[a-fA-F])([0-9a-f]{32,}|[0-9A-F]{32,})$") & ~digest
    return found.withColumn("is_secret", F.when(placeholder, False).when(_named(), True).when((alone & ~open_) | usual | digest, False))


def _nameless(found: DataFrame) -> DataFrame:
    """Candidates as if nothing named or quoted them."""
    header = rf"(?i)(authorization[\"'`]?\s*[=:]+\s*[\"'`]?)?({SCHEMES})\s+$"
    return found.withColumns({
        "before": F.regexp_replace(F.regexp_replace(F.regexp_replace("before", header, ""), _ASSIGNMENT, ""), "[\"'`]$", ""),
        "after": F.regexp_replace("after", "^[\"'`]", "")})


@dataclass(frozen=True)
class SecretModel:
    dictionary: Dictionary
    forest: RandomForestClassificationModel | None
    constant: float = 0.0


def fit(labelled: DataFrame, dictionary: Dictionary, train_findings: int = 5000, trees: int = 20, depth: int = 6, seed: int = 11) -> SecretModel:
    """A forest on at most ``train_findings`` labelled candidates of each label, those of least hash.

    Each different finding counts twice, once as it stands and once without its name and quotes.

    ``labelled`` has what ``candidates`` gives and is_secret; nulls are left
    out. With one label alone, or none, every finding gets that label's chance.
    """
    known = labelled.filter("is_secret is not null").dropDuplicates(["value", "before", "after", "is_secret"])
    known = written(known, "known")
    picked = [least_hashed(known.filter(F.col("is_secret") == v), train_findings, "value", "before", "after", "doc_id", "place") for v in (True, False)]
    sample = picked[0].unionByName(picked[1])
    sample = sample.unionByName(_nameless(sample))
    rows = written(described(sample, dictionary).select(*FEATURES, F.col("is_secret").cast("double").alias("label")), "findings")
    seen = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(seen) < 2:
        return SecretModel(dictionary, None, 1.0 if 1.0 in seen else 0.0)
    # Hashed words have no order: trees split them into sets of buckets.
    nominal = {"ml_attr": {"type": "nominal", "vals": [str(i) for i in range(BUCKETS)]}}
    # A split into sets takes at least as many rows as buckets; fewer findings are repeated alike.
    n = rows.count()
    if n < BUCKETS:
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(-(-BUCKETS // n))))).drop("copy")
    rows = rows.orderBy(*FEATURES, "label").select("label", *(F.col(n).alias(n, metadata=nominal) if n.endswith("_bucket") else n for n in FEATURES))
    inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("features", "label")
    # Each task returns the counts of all open nodes of all trees; a bounded sample needs few tasks.
    inputs = inputs.coalesce(4)
    return SecretModel(dictionary, RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=BUCKETS, seed=seed, featureSubsetStrategy="onethird").fit(inputs))


def scan(found: DataFrame, model: SecretModel, chance: float = 0.5) -> DataFrame:
    """Candidates with ``probability`` and the verdict ``is_secret``."""
    if model.forest is None:
        scored = found.withColumn("probability", F.lit(model.constant))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(described(found, model.dictionary))
        scored = model.forest.transform(vectors).withColumn("probability", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(*found.columns, "probability").withColumn("is_secret", F.col("probability") >= chance)


def masked(docs: DataFrame, findings: DataFrame) -> DataFrame:
    """The rows of ``docs`` with secrets in ``text`` replaced by ``MASK``; rows without one, null texts and null ids are unchanged."""
    bad = findings.filter("is_secret").groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places")).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "places")
    packed = docs.select(F.struct("*").alias("row"))
    joined = packed.join(bad, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("row.text") == F.col("_key")), "left")
    values, parts = F.regexp_extract_all("row.text", F.lit(CANDIDATE), F.lit(0)), F.split("row.text", CANDIDATE, -1)
    shown = F.transform(F.arrays_zip(parts.alias("part"), values.alias("value")), lambda p, i: F.concat(p["part"], F.when(F.array_contains("places", i), MASK).otherwise(F.coalesce(p["value"], F.lit("")))))
    text = F.when(F.col("places").isNotNull(), F.array_join(shown, "")).otherwise(F.col("row.text"))
    return joined.select(*((text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns))
