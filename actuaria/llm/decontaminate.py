"""Benchmark decontamination with a broadcast set of test n-grams, in DataFrame functions only.

Benchmark items and documents are normalised alike: A-Z lower-cased; a word is a run of
ASCII letters, digits and non-ASCII characters. A *window* is ``n`` consecutive item words
(an item of fewer words, but not none, is one window of its own length).

The windows become hash sets inside the scan's own expressions: one of the hashes of each
window's first two words, a cheap test at every document word, and one of whole windows,
tested only where the first test passed. The second set holds the windows' words, so a
member is a verified hit, not a hash match. Only hits leave the scan: the shuffle grows
with the contamination, not with the corpus.

The sets stand in the plan itself up to ``MAX_WINDOWS`` distinct windows. Beyond, the windows of the
documents (of the lengths that the benchmark has) meet a broadcast hash set inside the
scan, ``BROADCAST_WINDOWS`` benchmark windows at a time: 64-bit hashes, some 24 bytes each, in as many
blocks as the benchmark needs. What passes is verified by its words in a join of those few rows and
goes back to the documents by content key. The results are the same.

Defined results: null text or a text without words has no words and no hit; null or
word-less items have no window; an item repeated under one item_id counts once; an item
without item_id gives hits but is neither counted nor named; an empty benchmark leaves every
document clean; equal rows of documents give equal rows; long texts are scanned whole.
Columns other than doc_id and text pass through untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import content_key, fresh_name, stored, whole_text

N = 10
MAX_WINDOWS = 50_000
BROADCAST_WINDOWS = 2_000_000
WORD_CHARS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OTHER_CHARS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), OTHER_CHARS), "")


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per distinct window: gram (its words, space-joined), len, first (words), items."""
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item"), normal_words(whole_text()).alias("w")
    ).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(n))
    starts = F.sequence(F.lit(0), F.size("w") - length)
    grams = words.select("item", length.alias("len"), F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, length))).alias("g"))
    return grams.groupBy(F.array_join("g", " ").alias("gram"), "len").agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )


def _gram(words: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


NO_HITS = "cast(array() as array<struct<pos:int,len:int,gram:string>>)"


def _hits_at(words: str, starts: Column, length: int) -> Column:
    """The window candidate of ``length`` words at each start."""
    return F.transform(
        starts,
        lambda i: F.struct(
            i.alias("pos"), F.lit(length).alias("len"),
            F.array_join(F.slice(F.col(words), i + 1, length), " ").alias("gram"),
        ),
    )


def _hits_of_length(words: str, length: int, grams: list[str]) -> Column:
    if length == 1:
        starts = F.transform(F.col(words), lambda a, i: F.when(a.isin(grams), i))
    else:
        firsts = sorted({" ".join(g.split(" ")[:2]) for g in grams})
        following = F.slice(F.col(words), F.lit(2), F.size(words))
        # the last word has no successor: its pair with null never is a member
        passed = F.zip_with(
            F.col(words), following, lambda a, b: F.concat(a, F.lit(" "), b).isin(firsts)
        )
        starts = F.transform(passed, lambda hit, i: F.when(hit, i))
    starts = F.filter(starts, lambda i: i.isNotNull())
    return F.filter(_hits_at(words, starts, length), lambda h: h["gram"].isin(grams))


def _hits_in_scan(words: str, windows: list) -> Column:
    """Array of (pos, len, gram) of every window occurrence, from literal hash sets."""
    by_length: dict[int, list[str]] = {}
    for w in windows:
        by_length.setdefault(w["len"], []).append(w["gram"])
    return F.concat(F.expr(NO_HITS), *(_hits_of_length(words, n, g) for n, g in sorted(by_length.items())))


def _few(windows: DataFrame, max_windows: int) -> list | None:
    """The windows (gram, len), unless there are more than ``max_windows``."""
    few = windows.select("gram", "len").limit(max_windows + 1).collect()
    return few if len(few) <= max_windows else None


def _hits_by_broadcast(texts: DataFrame, windows: DataFrame, at_once: int) -> DataFrame:
    """(k, f) of the texts (k, text) with a window: f is their array of (pos, len, gram)."""
    windows = stored(windows.select("gram", "len"), "windows")
    sizes = windows.groupBy("len").agg(F.count("*").alias("n")).collect()  # a row for each length, at most n
    lengths, total = sorted(r["len"] for r in sizes), sum(r["n"] for r in sizes)
    # a one-element explode keeps the words a column of their own
    split = texts.select("k", F.explode(F.array(normal_words(F.col("text")))).alias("w"))
    none = F.expr("cast(array() as array<int>)")
    starts = [F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).otherwise(none) for n in lengths]
    every = F.concat(F.expr(NO_HITS), *(_hits_at("w", s, n) for s, n in zip(starts, lengths)))
    rows = split.select("k", F.explode(every).alias("h")).select("k", "h.*", F.xxhash64("h.gram").alias("x"))
    blocks = max(1, -(-total // at_once))
    hashes = windows.select(F.xxhash64("gram").alias("x")).distinct()
    passed = [
        rows.join(F.broadcast(hashes.where(F.pmod("x", F.lit(blocks)) == b)), "x", "left_semi")  # about at_once longs
        for b in range(blocks)
    ]
    # copies of one text give equal rows, combined before the shuffle
    seen = reduce(DataFrame.unionByName, passed).dropDuplicates(["k", "pos", "len"])
    verified = seen.join(windows, ["gram", "len"], "left_semi")
    return verified.groupBy("k").agg(F.collect_list(F.struct("pos", "len", "gram")).alias("f"))


def _with_hits(
    docs: DataFrame, benchmark: DataFrame, n: int, words: str, hits: str, max_windows: int, at_once: int
) -> DataFrame:
    """``docs`` with its words and the array of window occurrences."""
    # A one-element explode keeps the words a column of their own: a filter on the hits would
    # otherwise be pushed below and split the text anew for every window it looks at.
    windows = benchmark_windows(benchmark, n)
    few = _few(windows, max_windows)
    if few is not None:
        marked = docs.withColumn(words, F.explode(F.array(normal_words(whole_text()))))
        return marked.withColumn(hits, _hits_in_scan(words, few))
    texts = docs.select(whole_text().alias("text")).select(content_key(F.col("text")).alias("k"), "text")
    key = fresh_name(docs, "_text_key")
    found = _hits_by_broadcast(texts, windows, at_once).select(F.col("k").alias(key), F.col("f").alias(hits))
    joined = docs.withColumn(key, content_key(whole_text())).join(found, key, "left")
    return (
        joined.withColumn(hits, F.coalesce(F.col(hits), F.expr(NO_HITS)))
        .withColumn(words, normal_words(whole_text())).drop(key)
    )


def _covered(hits: str) -> Column:
    """Distinct 0-based positions of the words inside any occurrence."""
    spans = F.transform(F.col(hits), lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - 1))
    return F.array_distinct(F.flatten(spans))


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = N, max_windows: int = MAX_WINDOWS, at_once: int = BROADCAST_WINDOWS
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted array of item_id strings)."""
    marked = _with_hits(docs.select("doc_id", "text"), benchmark, n, "w", "hits", max_windows, at_once)
    thin = marked.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.size(_covered("hits")).cast("long").alias("n_hit"),
        F.array_distinct(F.transform("hits", lambda h: h["gram"])).alias("grams"),
    )
    windows = benchmark_windows(benchmark, n).select("gram", "items")
    each = thin.select("row", "doc_id", "n_words", "n_hit", F.explode_outer("grams").alias("gram"))
    return (
        each.join(windows, "gram", "left")
        .groupBy("row", "doc_id", "n_words", "n_hit")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .drop("row")
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = N, remove: str = "documents", max_windows: int = MAX_WINDOWS,
    at_once: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """``docs`` without the benchmark's windows, all columns kept.

    ``remove="documents"`` drops each document with a hit; ``"spans"`` keeps it and takes out
    the hit words, each with the separator after it (text null where it was null).
    """
    words, hits = fresh_name(docs, "_words"), fresh_name(docs, "_hits")
    marked = _with_hits(docs, benchmark, n, words, hits, max_windows, at_once)
    if remove == "documents":
        return marked.where(F.size(hits) == 0).select(*docs.columns)
    if remove != "spans":
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    # One struct per row, made by a one-element explode: its arrays are computed once a row,
    # where an expression inside a lambda would be computed anew for each word.
    parts = fresh_name(marked, "_parts")
    ready = F.struct(
        F.array_remove(F.split("text", OTHER_CHARS), "").alias("words"),
        F.split("text", WORD_CHARS).alias("gaps"),  # one more than there are words
        _covered(hits).alias("covered"),
    )
    opened = marked.withColumn(parts, F.explode(F.array(ready)))
    kept = F.array_except(
        F.filter(F.sequence(F.lit(0), F.size(f"{parts}.words")), lambda i: i < F.size(f"{parts}.words")),
        F.col(f"{parts}.covered"),
    )
    pieces = F.transform(kept, lambda i: F.concat(F.get(f"{parts}.words", i), F.get(f"{parts}.gaps", i + 1)))
    cleaned = F.concat(F.get(f"{parts}.gaps", F.lit(0)), F.array_join(pieces, ""))
    return opened.withColumn(
        "text", F.when(F.size(hits) == 0, F.col("text")).otherwise(cleaned)
    ).select(*docs.columns)
