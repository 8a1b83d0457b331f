"""Folding, matching, learning and held-out accuracy."""

import math
import random
import re

from pyspark.sql import functions as F

from actuaria.llm import toxicity as T
from tests.llm.helpers import empty_docs, odd_docs, prose, with_extras


def corpus(spark, n=240):
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        words, toxic = prose(500 + i, 60).split(), i % 4 == 0
        if toxic:
            words[10:10] = rnd.sample(["grublet", "snarkon", "vilewit"], 2) + ["here"]
        elif i % 3 == 0:
            words[20:20] = ["famous", "grublet", "museum"]  # harmless only in this phrase
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([*labels, labels[0], (None, 1), (5, None), (10**6, 1)], "doc_id long, toxic int")


def test_folding():
    assert T.fold("ІDІОТ") == "idiot" and T.fold("1d10t") == "idiot" and T.fold("ｉｄｉｏｔ") == "idiot"
    assert T.fold("id​iot") == "idiot" and T.fold("p@thetic") == "pathetic"
    assert T.fold("in 2019 é") == "in 2019 é" and T.fold("") == ""


def test_whole_words_and_neighbours():
    matcher = T.Matcher({"scum": 4.0, "scum bag": 5.0})
    assert [m[0] for m in matcher.matches("scum, scumming discum scum bag")] == ["scum", "scum", "scum bag"]
    assert matcher.matches("you scum there")[0] == ("scum", "you scum", "scum there")
    assert T.Matcher({}).matches("scum") == []


def test_learns_words_and_exceptions(spark):
    docs, labels = corpus(spark)
    model = T.fit(docs, labels, ~T.held_out())
    assert {"snarkon", "vilewit"} <= set(model.weights)
    scored = T.with_score(docs, model, "score").select("doc_id", "score").collect()
    wrong = [r["doc_id"] for r in scored if (r["score"] >= T.THRESHOLD) != (r["doc_id"] % 4 == 0)]
    assert len(wrong) <= 3
    kept = T.drop_toxic(with_extras(docs), model)
    assert kept.columns == with_extras(docs).columns and abs(kept.count() - 180) <= 3


def plain_score(text, model):
    """The score by a plain walk over the words of the folded text, word by word."""
    folded = T.fold(text)
    words = [(m.group(), *m.span()) for m in re.finditer(r"[^\W\d_]+", folded)]
    counted = []
    for word, a, b in words:
        before = re.findall(r"[^\W\d_]+", folded[max(0, a - 40) : a])
        after = re.findall(r"[^\W\d_]+", folded[b : b + 40])
        phrases = {f"{before[-1]} {word}" if before else "", f"{word} {after[0]}" if after else ""}
        if word in model.weights and not phrases & model.exceptions:
            counted.append(word)
    density = 100 * sum(model.weights[w] for w in counted) / max(folded.count(" ") + 1, 1)
    a, b, c = model.curve
    return 1 / (1 + math.exp(-(a + b * math.log1p(density) + c * math.log1p(len(set(counted))))))


def test_scores_equal_a_plain_walk(spark):
    docs, labels = corpus(spark)
    fitted = T.fit(docs, labels, ~T.held_out())
    model = T.Model(fitted.weights | {"grublet": 4.0}, frozenset({"famous grublet", "grublet museum"}), fitted.curve)
    rnd = random.Random(4)
    disguised = [(1000 + i, " ".join(rnd.choice([w, w.replace("i", "1"), w.upper()]) for w in t.split())) for i, (_, t) in
                 enumerate(map(tuple, docs.limit(80).collect()))]
    every = docs.unionByName(spark.createDataFrame(disguised, docs.schema)).unionByName(odd_docs(spark))
    for r in T.with_score(every, model, "score").collect():
        assert math.isclose(r["score"], plain_score(r["text"] or "", model), rel_tol=1e-9), r["doc_id"]


def test_the_driver_gets_numbers_only(spark):
    """Texts of any length with very many matches, repeated doc_ids: equal points are one row."""
    docs, labels = corpus(spark)
    long = docs.where("doc_id = 0").selectExpr("doc_id", "repeat(text || ' ', 2000) as text")
    several = docs.unionByName(long).unionByName(docs).unionByName(docs)
    once, thrice = T.fit(docs, labels, ~T.held_out()), T.fit(several, labels, ~T.held_out(), max_rows=100_000)
    assert set(once.weights) == set(thrice.weights) and once.curve[1] > 0 and thrice.curve[1] > 0


def test_exception_phrases_do_not_count():
    model = T.Model({"grublet": 5.0}, frozenset({"famous grublet"}), (-3.0, 2.0, 1.0))
    matcher = T.Matcher(model.weights)
    assert T.score("a famous grublet stood", matcher, model) < 0.1 < T.score("you grublet", matcher, model)


def test_odd_texts_and_missing_labels(spark):
    docs, labels = corpus(spark, 60)
    model = T.fit(docs, labels, ~T.held_out())
    scored = T.with_score(odd_docs(spark), model, "score").collect()
    assert len(scored) == odd_docs(spark).count() and all(0 <= r["score"] <= 1 for r in scored)
    assert T.with_score(empty_docs(spark), model, "score").count() == 0
    none = T.fit(docs, labels.where("toxic = 0"), ~T.held_out())
    assert none.weights == {} and T.fit(empty_docs(spark), labels.limit(0), ~T.held_out()).weights == {}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = T.fit(docs, labels, ~T.held_out())
    rows = T.with_score(docs, model, "score").join(labels, "doc_id").where(T.held_out())
    right = rows.agg(F.avg(((F.col("score") >= 0.7) == (F.col("toxic") == 1)).cast("int"))).first()[0]
    clean = rows.where("toxic = 0 and score >= 0.7").count()
    assert right >= 0.94 and clean <= 1
