"""Base spans against the plain patterns; disclosure against direct counting."""

import math
import re
import time

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from actuaria.llm import pii_sanitise as P
from tests.llm.helpers import empty_docs, odd_docs, prose, with_extras

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(digits[::-1])) % 10 == 0
            ok = [
                True, kind != 1 or all(int(p) <= 255 for p in m.group().split(".")),
                12 <= len(digits) <= 19 and luhn, 9 <= len(digits) <= 15,
            ][kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("a1@.2+- 0(9)é%\n45"), max_size=50))
def test_base_spans(text):
    assert P.base_spans(text) == plain(text)


def test_known_values():
    text = "é a.b@x.org, 10.0.0.255, 4111 1111 1111 1111; +49 (30) 1234567, 256.1.1.1 x@y"
    assert [P.KINDS[k] for k, _, _ in P.base_spans(text)] == ["email", "ip", "card", "phone"]
    assert P.base_spans("9" * 50000) == [] and P.base_spans("a" * 50000 + "@") == []
    assert P.base_spans("1." * 20000) == plain("1." * 20000)


def corpus():
    rows = []
    for i in range(40):
        text = prose(60 + i, 30)
        if i < 6:  # a signature line above, a word 50 words off, and the mail itself
            text = f"signed Zephyrus\nboss@corp.example about na\n{prose(i, 50)} quillon {text}"
        rows.append((i, text + (" common na" if i % 2 else "")))
    rows += [(50, f"{prose(70, 20)} zephyrus and quillon alone"), (51, "boss@corp.example 10.0.0.1 4111111111111111")]
    rows += [(60 + i, f"10.9.8.7 rare{'abc'[i]}word seen") for i in range(2)]  # two texts are too few
    return [*rows, (0, rows[0][1]), (None, rows[1][1]), (99, None)]


def direct(rows):
    """Words marked in every document, by counting everything directly."""
    texts = [t or "" for _, t in rows]
    free, held = [], []
    for t in texts:
        spans = plain(t)
        covered = {i for _, a, b in spans for i in range(a, b)}
        free.append([(m.group().lower(), m.start(), m.end()) for m in P.TERM.finditer(t) if not covered & set(range(*m.span()))])
        held.append({(k, t[a:b].lower()) for k, a, b in spans})
    words = [{w for w in P.TERM.findall(t.lower())} for t in texts]
    n, share = len(texts), {}
    for entity in set().union(*held):
        holders = [i for i in range(n) if entity in held[i]]
        information = math.log2(n / len(holders))
        for w in {w for i in holders for w, _, _ in free[i]}:
            both = [i for i in holders if w in {x for x, _, _ in free[i]}]
            if len({texts[i] for i in both}) >= P.MIN_TEXTS and information > 0:
                pmi = math.log2(len(both) * n / (sum(w in s for s in words) * len(holders)))
                share[w] = max(share.get(w, 0), pmi / information)
    kind = {w: P.ADDED[x >= P.REMOVE] for w, x in share.items() if x >= P.GENERALISE}
    out = []
    for (i, _), t, f in zip(rows, texts, free):
        spans = [(a, k, P.KINDS[k], b) for k, a, b in plain(t)]
        spans += [(a, len(P.KINDS) + P.ADDED.index(kind[w]), kind[w], b) for w, a, b in f if w in kind]
        out.append((str(i), ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))))
    return sorted(out), kind


@pytest.mark.parametrize("at_once", [P.TERMS_AT_ONCE, 2])
def test_spans_equal_direct_counting(spark, at_once):
    docs = with_extras(spark.createDataFrame(corpus(), "doc_id long, text string"))
    want, kind = direct(corpus())
    assert {"zephyrus", "quillon", "signed"} <= set(kind) and "common" not in kind and "rareaword" not in kind
    found = P.span_digests(P.private_spans(docs, terms_at_once=at_once))
    assert sorted((str(r["doc_id"]), r["spans"]) for r in found.collect()) == want
    assert "removed:" in dict(want)["50"]  # a document without the entity


def test_one_long_line_is_linear():
    """A line of very many entities and words: 16 times the length, far from 256 times the time."""

    def seconds(n):
        text = " ".join(f"10.{i % 250}.{i // 250 % 250}.7 word{'abcdefghij'[i % 10]}x" for i in range(n))
        begun = time.time()
        batch = pd.DataFrame({"doc_id": ["1"], "k": [b""], "text": [text]})
        next(P._entities(iter([batch])))
        added = next(P._spans_with({"wordax": 4})(iter([batch])))["added"][0]
        assert len(added) == n // 10
        return time.time() - begun

    short = max(seconds(4_000), 0.02)
    assert seconds(64_000) < 60 * short  # over 1 MB


def test_words_in_long_spans_are_no_terms():
    inside = "+1 (234) 567-8901." * 40  # many spans inside one long local part
    text = f"{inside}abcdef.ghijk@example.org word"
    assert [w for w, _, _ in P.free_terms(text, P.base_spans(text))] == ["word"]


def test_masked_texts_and_odd_rows(spark):
    docs = with_extras(spark.createDataFrame(corpus(), "doc_id long, text string"))
    masked = P.sanitise(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert "boss@" not in texts[3] and "<EMAIL>" in texts[3] and "zephyrus" not in texts[3] and texts[99] is None
    assert texts[30] == corpus()[30][1]
    assert P.mask("abcdef", [(1, 3, "email"), (2, 4, "ip"), (5, 6, "removed")]) == "a<EMAIL><IP>e"
    assert P.private_spans(odd_docs(spark)).count() == odd_docs(spark).count()
    assert P.private_spans(empty_docs(spark)).count() == 0
