"""Secret scan with a random forest against false positives, in DataFrame functions only.

*Candidates* are all runs of 16 or more key characters inside a white-space token, and the
values of any length, any signs in them, that are assigned to a credential word in the same
token or the ones before. Each comes with what a reviewer would look at: what stands before it (the two
tokens before and its own token's start; for a further run of a token the run before it and what
lies between; for an assigned value the name), the token after it, and the path it was found under.

*Features*: candidate length; transitions between character classes; shares of digits and capitals and
of different characters; the share of its letter trigrams known from the corpus's own dictionary;
path shape; and whether the neighbouring words speak of credentials, assign or quote.

*Model*: a random forest of Spark ML (JVM only) trained on labelled findings: candidates with
a 0/1 ``label``. :func:`train` takes any such frame. Where no reviewed findings are at hand,
:func:`rule_labels` labels candidates by issuer formats and explicit assignments.

The dictionary is counted over all texts (the most frequent ``DICTIONARY`` words); the forest
is fitted on at most ``MAX_FINDINGS`` different findings of each label, chosen by hash and weighted
by one and the logarithm of their copies. Candidates are scored
where they are found. Only word counts and the bounded training sample are shuffled, and
both are combined on the map side, so a word or secret in a third of all documents costs a row a task.

Defined results: null and empty texts have no candidate; repeated rows are each scanned; a null
path is the empty path; labels null are ignored; with findings of one label only the model keeps
or drops every candidate alike; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import hash_sample, stored, whole_text

MIN_LENGTH = 16
KEY_RUN = r"[A-Za-z0-9+/_-]{16,}"
DICTIONARY = 5000  # words
MAX_FINDINGS = 20_000  # of each label
TREES, DEPTH = 20, 6
SEED = 7
LETTERS = "abcdefghijklmnopqrstuvwxyz"
CLASSES = (LETTERS + LETTERS.upper() + "0123456789", "a" * 26 + "A" * 26 + "0" * 10)
# ---- fixed values: issuer formats and words that announce a credential -------------------
ISSUER = r"^((AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,})$"
CREDENTIAL_WORDS = r"(?i)(pass(word|wd|phrase)?|secret|token|api[_-]?key|access[_-]?key|credential|auth)"
ASSIGNED = r"(?i)(password|passwd|secret|token|api_?key|access_?key)[\"']?\s*[=:]\s*[\"']?$"
# -------------------------------------------------------------------------------------------
# a name that holds a credential word; the assignment sign; (name and sign) (value) (closing quote).
# Possessive and bounded, so that long tokens are read once. A name assigned to is no value itself.
NAME = r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|credential|auth)[A-Za-z0-9_-]{0,64}+\\*+[\"']?+"
SIGN = r"\s*+[=:][=>]?+"
VALUE = r"(?:(?<=\")[^\"]*[^\"\\]|(?<=')[^']*[^'\\]|(?<![\"'])[^\"',;&]+)"
GIVEN = rf"({NAME}{SIGN}\s*+\\*+[\"']?+)(?!{NAME}{SIGN})({VALUE})(?=([\"']?))"
FEATURES = [
    "length", "transitions", "digits", "capitals", "variety", "hexadecimal", "dictionary",
    "path_depth", "path_test", "path_code", "credential_near", "assigned", "quoted",
]


def candidates(docs: DataFrame, path: str) -> DataFrame:
    """One row per candidate: doc_id, path, at (token number), value, lead, before, after."""
    tokens = docs.select(
        "doc_id", F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        F.split(whole_text(), r"\s+").alias("t"), whole_text().rlike(f"{NAME}{SIGN}").alias("named"),
    )
    token = lambda i: F.get("t", i)
    before = lambda i: F.concat_ws(" ", F.get("t", i - 2), F.get("t", i - 1))
    has_run = lambda i: (F.length(token(i)) >= MIN_LENGTH) & token(i).rlike(KEY_RUN)
    # texts without any such assignment, nearly all, are spared the patterns on each token
    given = lambda i: F.col("named") & (token(i).rlike(GIVEN) | F.concat(before(i), F.lit(" "), token(i)).rlike(GIVEN))
    long = F.filter(F.sequence(F.lit(0), F.size("t") - 1), lambda i: has_run(i) | given(i))
    found = F.transform(
        long,
        lambda i: F.struct(
            i.alias("at"), token(i).alias("token"), before(i).alias("before"),
            F.coalesce(F.get("t", i + 1), F.lit("")).alias("after"),
        ),
    )
    rows = tokens.select("doc_id", "path", F.explode(found).alias("c"))
    parts = rows.select(
        "doc_id", "path", "c", F.regexp_extract_all("c.token", F.lit(KEY_RUN), F.lit(0)).alias("runs"),
        F.split("c.token", KEY_RUN, -1).alias("gaps"),
        *(F.regexp_extract_all("c.token", F.lit(GIVEN), F.lit(g)).alias(f"own{g}") for g in (1, 2, 3)),
        # a name, with or without its sign, that ends the tokens before; the value opens this one
        F.regexp_extract(F.concat("c.before", F.lit(" ")), f"({NAME}(?:{SIGN})?+\\s*+)$", 1).alias("dangling"),
    )
    joined = F.concat("dangling", "c.token")
    cross = [F.when(F.col("dangling") != "", F.regexp_extract(joined, f"^{GIVEN}", g)).otherwise("") for g in (1, 2, 3)]

    def row(lead: Column, value: Column, tail: Column) -> Column:
        return F.struct(value.alias("value"), lead.alias("lead"), tail.alias("tail"))

    runs = F.transform(
        "runs",
        lambda r, j: row(
            F.when(j == 0, F.concat("c.before", F.lit(" "), F.get("gaps", j))).otherwise(F.concat(F.get("runs", j - 1), F.get("gaps", j))),
            r, F.get("gaps", j + 1),
        ),
    )
    own = F.transform("own2", lambda v, j: row(F.get("own1", j), v, F.get("own3", j)))
    assigned = F.filter(
        F.array_append(own, row(*cross)),
        lambda x: (x["value"] != "") & ~F.array_contains("runs", x["value"]),
    )
    every = parts.select("doc_id", "path", "c", F.explode(F.concat(runs, F.array_distinct(assigned))).alias("x"))
    return every.select("doc_id", "path", "c.at", "x.value", "x.lead", "c.after", "x.tail")


def dictionary_trigrams(docs: DataFrame, words: int = DICTIONARY) -> list[str]:
    """Letter trigrams of the corpus's most frequent words (by documents that hold them)."""
    letters = F.array_distinct(F.split(F.lower(whole_text()), r"[^\p{L}]+"))
    counts = stored(
        docs.select(F.explode(letters).alias("w")).where(F.length("w") >= 3).groupBy("w").count(), "words"
    )
    # Words by steps of their count's logarithm (a few hundred steps): only the steps that hold
    # the most frequent words are sorted, not a share of every partition.
    step = F.floor(F.log2("count") * 8).cast("int")
    enough, lowest = 0, 0
    for row in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).orderBy(F.desc("s")).collect():
        enough, lowest = enough + row["n"], row["s"]
        if enough >= words:
            break
    top = counts.where(step >= lowest).orderBy(F.desc("count"), "w").limit(words)
    grams = F.transform(F.sequence(F.lit(1), F.length("w") - 2), lambda i: F.substring(F.col("w"), i, F.lit(3)))
    rows = top.select(F.explode(grams).alias("g")).distinct().collect()  # bounded by the dictionary
    return sorted(r["g"] for r in rows)


def with_features(found: DataFrame, trigrams: list[str]) -> DataFrame:
    """Candidates with the columns named in ``FEATURES`` (all doubles)."""
    value, size = F.col("value"), F.length("value")
    shape = F.translate(value, *CLASSES)
    share = lambda pattern: F.length(F.regexp_replace(value, pattern, "")) / size
    trigrams_at = F.when(size > 2, F.sequence(F.lit(1), size - 2)).otherwise(F.array().cast("array<int>"))
    each = F.transform(trigrams_at, lambda i: F.substring(F.lower(value), i, F.lit(3)))
    known = F.size(F.filter(each, lambda g: g.isin(trigrams or [""])))
    columns = {
        "length": size,
        "transitions": F.length(F.regexp_replace(shape, r"(.)\1+", "$1")) - 1,
        "digits": share("[^0-9]"),
        "capitals": share("[^A-Z]"),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / size,
        "hexadecimal": value.rlike("^[0-9a-f]+$"),
        "dictionary": known / F.greatest(size - 2, F.lit(1)),
        "path_depth": F.size(F.split("path", "/")),
        "path_test": F.lower("path").rlike("test|example|sample|fixture|mock"),
        "path_code": F.pmod(F.xxhash64(F.substring_index("path", "/", -1)), F.lit(16)),
        "credential_near": F.col("lead").rlike(CREDENTIAL_WORDS),
        "assigned": F.col("lead").rlike(r"[=:]\s*[\"']?$"),
        "quoted": F.col("lead").rlike("[\"']$") & F.col("tail").rlike("^[\"']"),
    }
    return found.withColumns({k: v.cast("double") for k, v in columns.items()})


def rule_labels(found: DataFrame) -> DataFrame:
    """Candidates with a ``label`` by issuer format or an explicit assignment to a credential."""
    issued = F.col("value").rlike(ISSUER)
    given = F.col("lead").rlike(ASSIGNED) & F.col("value").rlike("[0-9]")
    return found.withColumn("label", (issued | given).cast("double"))


@dataclass
class Model:
    """The dictionary and the forest; ``forest`` is None when all findings had one label."""

    trigrams: list[str]
    forest: RandomForestClassificationModel | None
    only: float = 0.0


def _assembled(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)


def train(findings: DataFrame, trigrams: list[str], max_findings: int = MAX_FINDINGS) -> Model:
    """Fit the forest on labelled findings (candidates with a 0/1 ``label``)."""
    keys = ["value", "lead", "after", "tail", "path"]
    # a threshold on the hash keeps or drops all copies alike: it must deal with different findings
    different = stored(
        findings.where(F.col("label").isin(0.0, 1.0)).groupBy("label", *keys).agg(F.count("*").alias("copies")), "different"
    )
    sample = [hash_sample(different.where(F.col("label") == label), keys, max_findings) for label in (0.0, 1.0)]
    damped = (1 + F.log2("copies")).alias("w")
    rows = stored(with_features(sample[0].unionByName(sample[1]), trigrams).select("label", damped, *FEATURES), "findings")
    kinds = {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.sum("w").alias("w")).collect()}
    if len(kinds) < 2:
        return Model(trigrams, None, next(iter(kinds), 0.0))
    weight = F.col("w") * F.when(F.col("label") == 1.0, kinds[0.0] / kinds[1.0]).otherwise(1.0)
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="w", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    ).fit(_assembled(rows.withColumn("w", weight)))
    return Model(trigrams, forest)


def score(found: DataFrame, model: Model) -> DataFrame:
    """Candidates with ``score``: the forest's share for a true secret."""
    if model.forest is None:
        return found.withColumn("score", F.lit(float(model.only)))
    done = model.forest.transform(_assembled(with_features(found, model.trigrams)))
    return done.withColumn("score", F.get(vector_to_array("probability"), F.lit(1))).select(*found.columns, "score")


def scan(docs: DataFrame, path: str, model: Model, threshold: float = 0.5) -> DataFrame:
    """Findings kept by the model: doc_id, at, path, value, score."""
    kept = score(candidates(docs, path), model).where(F.col("score") >= threshold)
    return kept.select("doc_id", "at", "path", "value", "score")
