"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

*Folding* undoes disguises: lower case, look-alike letters of other scripts, full-width
letters, zero-width marks, and digits or signs written for letters.

*Lexicon.* From labelled training rows, every folded word gets the smoothed log odds of
standing in a toxic text rather than a clean one; words with enough support and weight
make the lexicon. *Exception phrases* are two-word phrases around a lexicon word that stand
in clean texts nearly always: a match inside one does not count.

*Score.* All lexicon words are searched at once by one automaton. The weights of the matches,
normalised by the number of words, and the number of different words matched go through a
logistic curve fitted on the training rows.

The model is fitted on at most ``MAX_TRAINING_ROWS`` labelled rows (those with the smallest
hash of doc_id) and holds at most ``MAX_TERMS`` words, so sample and lexicon are broadcast
within a fixed bound; texts are scored where they are read, without a shuffle.

Defined results: null and empty texts have no match and get the curve's lowest score; a text
is scored by its words alone, so equal texts score alike; a document with several label rows
is toxic if any of them says so, null labels and label rows without document are ignored; with
no training rows of one kind the lexicon is empty and every score is the share of toxic
training rows. An empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import fresh_name, hash_sample, stored, whole_text

MAX_TRAINING_ROWS = 50_000
MAX_TERMS = 20_000
MIN_WEIGHT = 3.0  # log odds
MIN_SUPPORT, MIN_SUPPORT_SHARE = 3, 0.004
THRESHOLD = 0.7

# ---- fixed values: letters of other scripts that look like Latin ones -------------------
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѕ": "s", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "т": "t", "у": "y", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}
DIGIT_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGN_LETTERS = {"@": "a", "$": "s"}
ZERO_WIDTH = "­​‌‍⁠﻿"
# ------------------------------------------------------------------------------------------
WIDE = str.maketrans(
    LOOK_ALIKES | {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)} | {c: "" for c in ZERO_WIDTH}
)
DIGITS = re.compile(r"(?<=[^\W\d_])[0134578]+(?=[^\W_])|(?<![\w])[0134578]+(?=[^\W\d_])")
SIGNS = re.compile(r"(?<=[^\W\d_])[@$](?=[^\W\d_])")
WORDS = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """The text with disguised letters written plainly."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(WIDE).lower()
    if "@" in text or "$" in text:
        text = SIGNS.sub(lambda m: SIGN_LETTERS[m.group()], text)
    return DIGITS.sub(lambda m: "".join(DIGIT_LETTERS[c] for c in m.group()), text)


@dataclass(frozen=True)
class Model:
    """Word weights, exception phrases, and the curve (intercept, density, different words)."""

    weights: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = field(default=(0.0, 0.0, 0.0))


class Matcher:
    """The automaton over a model's words; finds them as whole words."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.automaton = ahocorasick.Automaton()
        for word in weights:
            self.automaton.add_word(word, word)
        if weights:
            self.automaton.make_automaton()

    def matches(self, folded: str) -> list[tuple[str, str, str]]:
        """(word, phrase with the word before, phrase with the word after) of each match."""
        found = []
        if not self.weights:
            return found
        n = len(folded)
        for end, word in self.automaton.iter(folded):
            start = end - len(word) + 1
            if (start and folded[start - 1].isalpha()) or (end + 1 < n and folded[end + 1].isalpha()):
                continue
            before = WORDS.findall(folded[max(0, start - 40) : start])
            after = WORDS.findall(folded[end + 1 : end + 41])
            found.append(
                (word, f"{before[-1]} {word}" if before else "", f"{word} {after[0]}" if after else "")
            )
        return found


def features(matches: list, words: int, model: Model) -> tuple[float, float]:
    """Weighted matches per hundred words (damped), and the number of different words."""
    counted = [w for w, before, after in matches if before not in model.exceptions and after not in model.exceptions]
    density = 100.0 * sum(model.weights[w] for w in counted) / max(words, 1)
    return float(np.log1p(density)), float(np.log1p(len(set(counted))))


def score(text: str, matcher: Matcher, model: Model) -> float:
    folded = fold(text)
    matches = matcher.matches(folded)
    x, y = features(matches, folded.count(" ") + 1, model) if matches else (0.0, 0.0)
    a, b, c = model.curve
    return float(1.0 / (1.0 + np.exp(-(a + b * x + c * y))))


# ---- fitting --------------------------------------------------------------------------
def _fit_curve(x: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> tuple[float, float, float]:
    """Ridge-damped logistic regression by Newton steps; never falling in a feature.

    ``rows`` is the number of texts that each line of ``x`` stands for.
    """
    design = np.column_stack([np.ones(len(x)), x])
    beta, damp = np.zeros(3), np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (rows * (toxic - p)) - damp @ beta
        step = np.linalg.solve((design.T * (rows * p * (1 - p))) @ design + damp, grad)
        beta = np.clip(beta + np.clip(step, -5, 5), [-30, 0, 0], 30)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of each kind that hold a word, counted within a batch first."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch["text"], batch["toxic"]):
            counts[int(toxic)].update(set(WORDS.findall(fold(text))))
        words = list(counts[0].keys() | counts[1].keys())
        yield pd.DataFrame({"word": words, "clean": [counts[0][w] for w in words], "bad": [counts[1][w] for w in words]})


def fit(docs: DataFrame, labels: DataFrame, training: Column, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Learn a model from the labelled rows whose doc_id meets ``training`` (a Column)."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & training)
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    sample = hash_sample(known, ["doc_id"], max_rows)
    texts = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id")
    kinds = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, bad = kinds.get(0, 0), kinds.get(1, 0)
    if not clean or not bad:
        share = (bad + 0.5) / (clean + bad + 1)
        return Model({}, curve=(float(np.log(share / (1 - share))), 0.0, 0.0))

    counts = texts.select("text", "toxic").mapInPandas(_word_counts, "word string, clean long, bad long")
    counts = counts.groupBy("word").agg(F.sum("clean").alias("c"), F.sum("bad").alias("b"))
    weight = F.log((F.col("b") + 0.5) / (F.lit(bad) - F.col("b") + 0.5)) - F.log(
        (F.col("c") + 0.5) / (F.lit(clean) - F.col("c") + 0.5)
    )
    support = max(MIN_SUPPORT, MIN_SUPPORT_SHARE * bad)
    lexicon = (
        counts.where(F.col("b") >= support).withColumn("weight", weight).where(F.col("weight") >= MIN_WEIGHT)
        .orderBy(F.desc(F.col("weight") * F.col("b")), "word").limit(MAX_TERMS).collect()
    )
    weights = {r["word"]: float(r["weight"]) for r in lexicon}

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(weights)
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                folded = fold(text)
                found = matcher.matches(folded)
                rows.append((int(toxic), folded.count(" ") + 1, ["|".join(m) for m in found]))
            yield pd.DataFrame(rows, columns=["toxic", "words", "found"])

    seen = stored(
        texts.select("text", "toxic").mapInPandas(find, "toxic int, words int, found array<string>"), "matches"
    )
    phrases = seen.select("toxic", F.explode(F.array_distinct(F.flatten(F.transform(
        "found", lambda m: F.slice(F.split(m, r"\|"), 2, 2)
    )))).alias("phrase")).where("phrase != ''")
    exceptions = (
        phrases.groupBy("phrase").agg(F.count("*").alias("n"), F.sum("toxic").alias("b"))
        .where((F.col("n") - F.col("b") >= support) & (F.col("b") <= 0.1 * F.col("n")))
        .orderBy(F.desc("n"), "phrase").limit(MAX_TERMS).collect()
    )
    model = Model(weights, frozenset(r["phrase"] for r in exceptions))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (toxic, *features([tuple(m.split("|")) for m in found], words, model))
                for toxic, words, found in zip(batch["toxic"], batch["words"], batch["found"])
            ]
            yield pd.DataFrame(rows, columns=["toxic", "x", "y"])

    # three numbers a text leave the executors, equal ones as one row
    points = seen.mapInPandas(measure, "toxic int, x double, y double").groupBy("toxic", "x", "y").agg(F.count("*").alias("n"))
    rows = hash_sample(stored(points, "points"), ["toxic", "x", "y"], max_rows).collect()
    columns = (np.array([r[c] for r in rows], dtype=float) for c in ("x", "y", "toxic", "n"))
    x, y, toxic, n = columns
    return Model(model.weights, model.exceptions, _fit_curve(np.column_stack([x, y]), toxic, n))


def with_score(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """``docs`` with the toxicity score (0 to 1) of ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.exceptions, model.curve))

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        learned = Model(*shared.value)
        matcher = Matcher(learned.weights)
        for texts in batches:
            yield pd.Series([score(t, matcher, learned) for t in texts], dtype="float64")

    return docs.withColumn(column, F.pandas_udf(scores, "double")(whole_text()))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored at ``threshold`` or more, all columns kept."""
    column = fresh_name(docs, "_toxicity")
    return with_score(docs, model, column).where(F.col(column) < threshold).drop(column)


def held_out() -> Column:
    """The rows kept from training: crc32 of the doc_id's text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
