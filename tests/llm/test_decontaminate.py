"""Window hits against a direct scan, for both ways of matching."""

import re

import pytest

from actuaria.llm import decontaminate as D
from tests.llm.helpers import empty_docs, prose, with_extras

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(D.UPPER, D.LOWER)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, n=10):
    grams = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                g = tuple(w[i : i + size])
                if g in grams:
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in grams[g] if x is not None}
        out.append((str(doc), len(w), len(hit), sorted(found)))
    return sorted(out)


PASSAGE = prose(11, 30)
SHOUTED = PASSAGE.translate(str.maketrans(D.LOWER, D.UPPER))
ITEMS = [(10, SHOUTED), (9, "Solo"), (9, "Solo"), (8, "two words"), (None, prose(12, 14)), (3, None), (4, "--"), (2, PASSAGE[30:120])]
DOCS = [
    (1, None), (2, ""), (3, "..."), (4, "solo"), (4, "solo"), (None, "solo two-words two words"), (5, prose(13, 50)),
    (6, f"{prose(14, 20)}, {PASSAGE} {prose(15, 20)}"), (7, PASSAGE), (8, " ".join(PASSAGE.split()[:9])),
    (9, " ".join(PASSAGE.split()[3:13])), (10, prose(12, 14)), (11, (PASSAGE + "! ") * 300), (12, "É" + PASSAGE),
]


@pytest.mark.parametrize("most, at_once", [(D.MAX_WINDOWS, 1), (0, D.BROADCAST_WINDOWS), (0, 7)])
def test_hits_match_a_direct_scan(spark, most, at_once):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = D.contamination(docs, items, max_windows=most, at_once=at_once).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in got) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("most", [D.MAX_WINDOWS, 0])
def test_removing_documents_or_spans(spark, most):
    docs = with_extras(spark.createDataFrame(DOCS, "doc_id long, text string"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    hit = {d for d, _, n, _ in brute(DOCS, ITEMS) if n}
    kept = D.decontaminate(docs, items, max_windows=most)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, t in DOCS if not brute([(d, t)], ITEMS)[0][2])
    cleaned = {str(r["doc_id"]): r["text"] for r in D.decontaminate(docs, items, remove="spans", max_windows=most).collect()}
    assert cleaned["1"] is None and cleaned["2"] == "" and cleaned["5"] == prose(13, 50)
    assert cleaned["7"] == "" and cleaned["6"] == f"{prose(14, 20)}, {prose(15, 20)}" and "7" in hit
    with pytest.raises(ValueError):
        D.decontaminate(docs, items, remove="all")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert D.contamination(empty_docs(spark), none).count() == 0
    assert all(r["n_hit"] == 0 for r in D.contamination(docs, none).collect())
    assert D.decontaminate(docs, none).count() == len(DOCS)


def test_a_large_benchmark_leaves_the_corpus_in_the_scan(spark):
    """Only the documents' hits are shuffled: their windows meet a broadcast set before any exchange."""
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    texts = docs.selectExpr("cast(cast(doc_id as string) as binary) as k", "coalesce(text, '') as text")
    plan = D._hits_by_broadcast(texts, D.benchmark_windows(items), 1000)._jdf.queryExecution().executedPlan().toString()
    above = plan.index("Exchange hashpartitioning")  # the first exchange above the scan of the documents
    assert "BroadcastHashJoin" in plan[above:] and "LeftSemi" in plan[above:]
