"""Personal data: base patterns, and terms that reveal a protected entity.

*Base spans* are the matches of four fixed patterns (e-mail, IP address, payment card, phone)
with their checks. Each distinct matched value is a protected *entity*.

*Disclosure.* Corpus co-occurrence estimates how strongly a word reveals an entity: with
document probabilities, the pointwise mutual information
``log2(p(term, entity) / (p(term) p(entity)))`` is the information the term gives about the
entity, out of the entity's own ``-log2 p(entity)``. A word that stands in the documents of an entity, in at least
``MIN_TEXTS`` different texts, and whose share of that information reaches ``GENERALISE`` is generalised
(its place says only that a word stood there); from ``REMOVE`` on it is removed. Every occurrence
is, in every document: a document that leaves the entity out is where the word discloses most.

*Scans.* The first one finds the entities, and the different words of documents with an
entity. Entities and words of fewer than ``MIN_TEXTS`` texts can reach no pair and are left out before pairs are
made, as are words too frequent for the share with any entity; copies of a text count as rows of
one. The second scan counts the words of the whole corpus, added up within each batch before the shuffle. The
third finds the base spans again and marks the revealing words, whose table is broadcast at most
``TERMS_AT_ONCE`` at a time (more words take more scans), so nothing of a text is ever shuffled. The
work on a text grows with its length, whatever stands in it.

Defined results: null text is the empty text and has no span; equal texts give equal rows; an empty
table gives an empty result; words inside base spans are never terms; a word that reveals
several entities gets the stronger treatment; null doc_id is kept; other columns are not read by the
search and pass through :func:`sanitise` untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import content_key, fresh_name, stored, whole_text

# ---- fixed values: the base patterns ----------------------------------------------------
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match never starts within a run of digits: from there it would end as from the run's start
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
# ------------------------------------------------------------------------------------------
ADDED = ("generalised", "removed")
MIN_TEXTS = 3
TERMS_AT_ONCE = 200_000
GENERALISE, REMOVE = 0.7, 0.9
TERM = re.compile(r"[^\W\d_]{3,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of every base match, by start and kind."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((3, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def free_terms(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(word, start, end) of every word outside the spans, in one walk over both."""
    i, end = 0, 0  # end: how far the spans that begin before the word reach
    for m in TERM.finditer(text):
        while i < len(spans) and spans[i][1] < m.end():
            end = max(end, spans[i][2])
            i += 1
        if m.start() >= end:
            yield m.group().lower(), m.start(), m.end()


def _entity(kind: int, value: str) -> str:
    return hashlib.sha256(f"{KINDS[kind]}:{value.lower()}".encode()).hexdigest()[:32]


def _small(batches: Iterator[pd.DataFrame], rows: int = 512) -> Iterator[pd.DataFrame]:
    """The batches in parts, so that what a part gives stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def _entities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of the texts with an entity: k, their different entities and free words."""
    for batch in _small(batches):
        rows = []
        for k, text in zip(batch["k"], batch["text"]):
            spans = base_spans(text)
            if spans:
                entities = sorted({_entity(kind, text[a:b]) for kind, a, b in spans})
                rows.append((k, entities, sorted({w for w, _, _ in free_terms(text, spans)})))
        yield pd.DataFrame(rows, columns=["k", "entities", "terms"])


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for text in batch["text"]:
            counts.update({w.lower() for w in TERM.findall(text)})
        yield pd.DataFrame({"term": list(counts), "n": list(counts.values())})


def revealing_terms(docs: DataFrame) -> DataFrame:
    """(entity, term, share) of the terms that reveal an entity beyond ``GENERALISE``.

    ``docs`` has ``k`` (content key) and ``text``, one row for each document.
    """
    scanned = docs.mapInPandas(_entities, "k binary, entities array<string>, terms array<string>")
    scanned = stored(scanned, "entities")
    rows = stored(scanned.groupBy("k").agg(F.count("*").alias("rows")), "rows")  # copies are rows of one text

    def supported(column: str, name: str) -> DataFrame:
        """(k, name) of the different texts, for values in enough of them."""
        each = scanned.select("k", F.explode(column).alias(name)).distinct()
        often = each.groupBy(name).agg(F.count("*").alias("texts")).where(F.col("texts") >= MIN_TEXTS).select(name)
        return each.join(stored(often, name), name)

    of_entity = stored(supported("entities", "entity"), "of-entity")
    entities = stored(of_entity.join(rows, "k").groupBy("entity").agg(F.sum("rows").alias("n_entity")), "entity-rows")
    total, most = docs.count(), entities.agg(F.max("n_entity")).first()[0] or 0

    # share >= GENERALISE needs n_term <= both * (total / n_entity) ** (1 - GENERALISE), and both <= n_entity
    highest = int(most**GENERALISE * total ** (1 - GENERALISE)) + 1
    of_term = supported("terms", "term").join(of_entity.select("k").distinct(), "k", "left_semi")
    wanted = stored(of_term.select("term").distinct(), "terms")
    words = docs.select("text").mapInPandas(_word_counts, "term string, n long")
    counts = words.groupBy("term").agg(F.sum("n").alias("n_term")).where(F.col("n_term") <= highest)
    counts = stored(counts.join(wanted, "term", "left_semi"), "term-rows")

    pairs = of_entity.join(of_term.join(counts.select("term"), "term"), "k").join(rows, "k")
    pairs = pairs.groupBy("entity", "term").agg(F.sum("rows").alias("both"), F.count("*").alias("texts"))
    joined = pairs.where(F.col("texts") >= MIN_TEXTS).join(entities, "entity").join(counts, "term")
    information = F.log2(F.lit(total) / F.col("n_entity"))
    pmi = F.log2(F.col("both") * F.lit(total) / (F.col("n_term") * F.col("n_entity")))
    share = F.when(information > 0, pmi / information)
    return joined.select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE)


def _span_text(spans: Column) -> Column:
    """kind:start:end of each span, by start and kind, comma-joined."""
    parts = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")


def _spans_with(marked: dict[str, int]):
    """Rows of doc_id, k, base and added spans; ``marked`` has the rank of each revealing word."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _small(batches):
            rows = []
            for doc_id, k, text in zip(batch["doc_id"], batch["k"], batch["text"]):
                spans = base_spans(text)
                added = [(a, marked[w], b) for w, a, b in free_terms(text, spans) if w in marked] if marked else []
                rows.append((doc_id, k, [(a, kind, b) for kind, a, b in spans], added))
            yield pd.DataFrame(rows, columns=["doc_id", "k", "base", "added"])

    return scan


PLACES = "array<struct<start:int,rank:int,end:int>>"


def private_spans(docs: DataFrame, terms_at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """doc_id, k (content key), base and added spans of every row of ``docs``.

    ``base`` and ``added`` are arrays of (start, rank, kind, end), ends exclusive, in code points.
    """
    keyed = docs.select("doc_id", whole_text().alias("text")).withColumn("k", content_key(F.col("text")))
    strongest = revealing_terms(keyed.select("k", "text")).groupBy("term").agg(F.max("share").alias("share"))
    strong = (F.col("share") >= REMOVE).cast("int")
    found = stored(strongest.select("term", (strong + len(KINDS)).alias("rank")), "revealing")
    scans = max(1, -(-found.count() // terms_at_once))
    block = F.pmod(F.xxhash64("term"), F.lit(scans))
    rows = keyed.select(F.col("doc_id").cast("string"), "k", "text")
    parts = []
    for i in range(scans):
        marked = {r["term"]: r["rank"] for r in found.where(block == i).collect()}  # about terms_at_once words
        parts.append(rows.mapInPandas(_spans_with(marked), f"doc_id string, k binary, base {PLACES}, added {PLACES}"))
    whole = parts[0]
    if scans > 1:  # the marks of the other scans, by text
        others = reduce(DataFrame.unionByName, parts[1:]).where(F.size("added") > 0).dropDuplicates(["k", "added"])
        more = others.groupBy("k").agg(F.flatten(F.collect_list("added")).alias("more"))
        none = F.expr(f"cast(array() as {PLACES})")
        whole = whole.join(more, "k", "left").withColumn("added", F.concat("added", F.coalesce("more", none)))
    names = F.array(*(F.lit(x) for x in (*KINDS, *ADDED)))

    def named(column: str) -> Column:
        return F.transform(
            column,
            lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), F.get(names, s["rank"]).alias("kind"), s["end"].alias("end")),
        ).alias(column)

    return whole.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "k", named("base"), named("added")
    )


def span_digests(found: DataFrame) -> DataFrame:
    """The counts of each base kind, the base spans' digest and all spans as text."""
    return found.select(
        "doc_id", *(_count_of(kind) for kind in KINDS), F.sha2(_span_text(F.col("base")), 256).alias("base_sha256"),
        _span_text(F.concat("base", "added")).alias("spans"),
    )


def _count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with base spans named, generalised words blanked and removed ones gone."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if end <= at:
            continue
        out.append(text[at : max(at, start)])
        out.append({"removed": "", "generalised": "<WORD>"}.get(kind, f"<{kind.upper()}>"))
        at = end
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` masked, all columns and rows kept."""
    key, spans = fresh_name(docs, "_text_key"), fresh_name(docs, "_spans")
    found = private_spans(docs).where((F.size("base") > 0) | (F.size("added") > 0)).dropDuplicates(["k"])
    found = found.select(F.col("k").alias(key), F.concat("base", "added").alias(spans))

    def masked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, every in batches:
            yield pd.Series(
                [
                    t if t is None or s is None else mask(t, [(x["start"], x["end"], x["kind"]) for x in s])
                    for t, s in zip(texts, every)
                ],
                dtype=object,
            )

    joined = docs.withColumn(key, content_key(whole_text())).join(found, key, "left")
    return joined.withColumn("text", F.pandas_udf(masked, "string")("text", spans)).select(*docs.columns)
