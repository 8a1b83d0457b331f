"""Substring deduplication: words covered by passages that recur anywhere in the corpus.

A *window* is ``window`` consecutive words of one text; it *recurs* when its word sequence
starts at two places or more, of one text or of several. Every word inside a recurring window
is removed, judged on the input.

1. *Seeds.* Of each window the phrase of ``seed`` words with the smallest hash is kept (a
   minimizer), so equal windows keep equal seeds and about one word in twelve starts one. Seeds are
   counted over all texts, as thin rows; windows whose seed does not recur cannot recur.
2. *Confirmation.* Around each recurring seed the windows it stands for are cut out as one
   snippet. Snippets of one seed meet in one place, where their windows are compared word
   for word. Runs of recurring windows are the confirmed passages.
3. *Location.* The passages of each seed are compiled into an Aho-Corasick automaton (the
   automata are sharded by seed), and the snippets of all texts with that seed are
   streamed through it; every occurrence gives a range of words of its text.
4. *Removal.* The ranges go back to the texts by content key.

Texts are handled once per content: rows with one text are its *copies*, and a text with two copies
recurs as a whole. Seeds and windows that repeat inside one text are one row with their places, so
a text that says the same thing over and over stays small. A seed with over ``HOT`` places (a
very common passage) is not gathered: its windows are counted as 128-bit digests in an aggregate
combined on the map side, and the texts' own digests are joined with those that recur, one row
for each text and window, with the same result. ``HOT`` snippets of a seed are some 8 MB.

Defined results: null text has no words; texts shorter than a window lose nothing; repeated rows
are copies of each other; equal texts give equal rows; null doc_id is kept; an empty table gives
an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import content_key, packed, stored, whole_text

WINDOW = 35
SEED = 12
HOT = 20_000
CACHE = 150_000  # word hashes remembered by a task


# ---- seeds ----------------------------------------------------------------------------
class SeedFinder:
    """Seed hashes of texts; equal word sequences always give equal seeds."""

    def __init__(self, window: int, seed: int):
        self.window, self.seed = window, min(seed, window)
        self.span = window - self.seed + 1
        digest = hashlib.sha256(b"seed").digest()
        self.factors = [
            np.uint64(int.from_bytes(hashlib.sha256(digest + bytes([i])).digest()[:8], "little") | 1)
            for i in range(self.seed)
        ]
        self.known: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """Hash of the seed phrase that starts at each word."""
        known, digest = self.known, xxhash.xxh64_intdigest
        if len(known) > CACHE:
            known.clear()
        codes = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = digest(w)
            codes.append(h)
        code = np.array(codes, dtype=np.uint64)
        n = len(words) - self.seed + 1
        total = np.zeros(n, dtype=np.uint64)
        for i, factor in enumerate(self.factors):
            total += code[i : i + n] * factor
        total ^= total >> np.uint64(29)
        total *= self.factors[0]
        return total ^ (total >> np.uint64(32))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Starts of the seeds kept for some window."""
        least = sliding(hashes, self.span, np.minimum)
        edge = np.zeros(self.span - 1, dtype=np.uint64)
        most = sliding(np.concatenate([edge, least, edge]), self.span, np.maximum)
        return np.flatnonzero(hashes == most)

    def owners(self, hashes: np.ndarray) -> np.ndarray:
        """Start of the seed of each window (the first of equal ones); never decreasing."""
        rows = np.lib.stride_tricks.sliding_window_view(hashes, self.span)
        return np.concatenate(
            [rows[a : a + 65536].argmin(axis=1) + np.arange(a, min(a + 65536, len(rows))) for a in range(0, len(rows), 65536)]
        )


def sliding(values: np.ndarray, width: int, combine) -> np.ndarray:
    """``combine`` (min or max) over every ``width`` neighbours, in logarithmic steps."""
    out, span = values, 1
    while 2 * span <= width:
        out = combine(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return combine(out[: len(out) - rest], out[rest:]) if rest else out


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


# ---- confirmation and location --------------------------------------------------------
def confirmed_passages(snippets: dict[bytes, int], window: int) -> set[bytes]:
    """Maximal runs of recurring windows of the snippets (each with its number of places)."""
    counts: dict[bytes, int] = {}
    split = {s: s.split(b" ") for s in snippets}
    for s, places in snippets.items():
        words = split[s]
        for i in range(len(words) - window + 1):
            key = b" ".join(words[i : i + window])
            counts[key] = counts.get(key, 0) + places
    passages = set()
    for words in split.values():
        start = None
        for i in range(len(words) - window + 2):
            inside = i <= len(words) - window and counts[b" ".join(words[i : i + window])] > 1
            if inside and start is None:
                start = i
            elif not inside and start is not None:
                passages.add(b" ".join(words[start : i - 1 + window]))
                start = None
    return passages


def locate(snippets: dict[bytes, int], passages: set[bytes]) -> dict[bytes, list[tuple[int, int]]]:
    """Word ranges of every passage occurrence in each snippet, by one automaton."""
    automaton = ahocorasick.Automaton()
    for p in passages:
        text = f" {p.decode('latin-1')} "  # one letter per byte; spaces at both ends of words
        automaton.add_word(text, (len(text), p.count(b" ") + 1))
    automaton.make_automaton()
    found = {}
    for s in snippets:
        text = f" {s.decode('latin-1')} "
        ranges = []
        for end, (length, words) in automaton.iter(text):
            first = text.count(" ", 0, end - length + 2) - 1
            ranges.append((first, first + words))
        found[s] = ranges
    return found


def _seed_ranges(rows: list[tuple], window: int) -> Iterator[tuple]:
    """(k, start, stop) word ranges of the rows (k, start, copies, snippet) of one seed."""
    snippets: dict[bytes, int] = {}
    for _, _, copies, snippet in rows:
        snippets[snippet] = snippets.get(snippet, 0) + copies
    if len(snippets) == 1:  # one passage, recurring as a whole or not at all
        ((snippet, places),) = snippets.items()
        found = {snippet: [(0, snippet.count(b" ") + 1)] if places > 1 else []}
    else:
        passages = confirmed_passages(snippets, window)
        found = locate(snippets, passages) if passages else {}
    for k, start, copies, snippet in rows:
        if copies == 1:  # a text with copies goes as a whole
            for a, b in found.get(snippet, ()):
                yield k, start + a, start + b


def merged(starts: list[int], window: int) -> list[dict]:
    """Word ranges covered by the windows at ``starts`` (rising), overlaps joined."""
    out: list[dict] = []
    for a in starts:
        if out and a <= out[-1]["stop"]:
            out[-1]["stop"] = a + window
        else:
            out.append({"start": a, "stop": a + window})
    return out


# ---- the operator -----------------------------------------------------------------------
def _summaries(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """One row per content: k, copies, n_words, whole_sha, and its seeds and their places."""

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = SeedFinder(window, seed)
        for batch in batches:
            rows = []
            for k, text in zip(batch["k"], batch["text"]):
                words = text.encode("utf-8").split()
                sha = hashlib.sha256(b" ".join(words)).hexdigest()
                seeds, places = np.empty(0, np.int64), []
                if len(words) >= window:
                    hashes = finder.hashes(words)
                    at = finder.places(hashes).astype(np.int32)
                    order = np.argsort(_signed(hashes[at]), kind="stable")
                    seeds, first = np.unique(_signed(hashes[at])[order], return_index=True)
                    places = np.split(at[order], first[1:])
                rows.append((k, len(words), sha, seeds, places))
            yield pd.DataFrame(rows, columns=["k", "n_words", "whole_sha", "seeds", "places"])

    each = texts.mapInPandas(summarise, "k binary, n_words long, whole_sha string, seeds array<long>, places array<array<int>>")
    return each.groupBy("k").agg(
        F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("whole_sha").alias("whole_sha"),
        F.first("seeds").alias("seeds"), F.first("places").alias("places"),
    )


def recurring_ranges(summaries: DataFrame, bodies: DataFrame, window: int, seed: int, hot: int) -> DataFrame:
    """Word ranges (k, start, stop) covered by recurring windows, for texts of one copy."""
    seeds = summaries.select(
        "k", "copies", F.explode(F.arrays_zip("seeds", "places")).alias("s")
    ).select("k", "copies", F.col("s.seeds").alias("seed"), F.col("s.places").alias("at"))
    often = (
        seeds.groupBy("seed").agg(F.sum(F.col("copies") * F.size("at")).alias("n"), F.sum(F.size("at")).alias("m"))
        .where(F.col("n") > 1).select("seed", (F.col("m") > hot).alias("hot"))
    )
    wanted = seeds.join(often, "seed").groupBy("k", "copies").agg(
        F.flatten(F.collect_list(F.when(~F.col("hot"), F.col("at")))).alias("cold"),
        F.flatten(F.collect_list(F.when(F.col("hot"), F.col("at")))).alias("hot"),
    )
    met = bodies.join(wanted, "k")

    def owned(batch: pd.DataFrame, column: str, finder: SeedFinder, reader) -> Iterator[tuple]:
        """(k, copies, words, seed, first window, last window) of the seeds in ``column``."""
        for k, copies, body, places in zip(batch["k"], batch["copies"], batch["body"], batch[column]):
            if not len(places):
                continue
            words = reader.decompress(body).split()
            hashes = finder.hashes(words)
            owner = finder.owners(hashes)
            places = np.sort(np.asarray(places))
            first, stop = np.searchsorted(owner, places, "left"), np.searchsorted(owner, places, "right")
            code = _signed(hashes)
            for p, a, b in zip(places.tolist(), first.tolist(), stop.tolist()):
                if a < b:
                    yield k, copies, words, int(code[p]), a, b - 1

    def cut_snippets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder, reader = SeedFinder(window, seed), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows = [
                    (s, k, a, copies, b" ".join(words[a : b + window]))
                    for k, copies, words, s, a, b in owned(batch.iloc[at : at + 256], "cold", finder, reader)
                ]
                yield pd.DataFrame(rows, columns=["seed", "k", "start", "copies", "snippet"])

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, current = [], None
        for batch in batches:
            out = []
            for s, *row in batch[["seed", "k", "start", "copies", "snippet"]].itertuples(index=False, name=None):
                if s != current:
                    if rows:
                        out.extend(_seed_ranges(rows, window))
                    rows, current = [], s
                rows.append(tuple(row))
            yield pd.DataFrame(out, columns=["k", "start", "stop"])
        yield pd.DataFrame(list(_seed_ranges(rows, window)) if rows else [], columns=["k", "start", "stop"])

    snippets = met.select("k", "copies", "body", "cold", "hot").mapInPandas(
        cut_snippets, "seed long, k binary, start int, copies long, snippet binary"
    )
    cold = (
        snippets.repartition("seed").sortWithinPartitions("seed")
        .mapInPandas(confirm, "k binary, start int, stop int")
    )

    def cut_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder, reader = SeedFinder(window, seed), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, len(batch)):  # one text at a time
                starts: dict[bytes, list[int]] = {}
                for k, copies, words, _, a, b in owned(batch.iloc[at : at + 1], "hot", finder, reader):
                    for i in range(a, b + 1):
                        w = hashlib.sha256(b" ".join(words[i : i + window])).digest()[:16]
                        starts.setdefault(w, []).append(i)
                if starts:
                    yield pd.DataFrame(
                        [(w, k, copies * len(x), copies, merged(x, window)) for w, x in starts.items()],
                        columns=["w", "k", "n", "copies", "ranges"],
                    )

    windows = met.select("k", "copies", "body", "cold", "hot").mapInPandas(
        cut_windows, "w binary, k binary, n long, copies long, ranges array<struct<start:int,stop:int>>"
    )
    recurring = windows.groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") > 1).select("w")
    single = windows.where(F.col("copies") == 1)
    # a window met twice in one text recurs by itself; only the others need the counts
    known = single.where(F.col("n") > 1).select("k", "ranges")
    found = single.where(F.col("n") == 1).join(recurring, "w").select("k", "ranges")
    warm = known.unionByName(found).select("k", F.inline("ranges"))
    return cold.unionByName(warm)


def remove_recurring(docs: DataFrame, window: int = WINDOW, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words joined by spaces; null: none removed).

    ``whole_sha`` is the SHA-256 of all words joined, for rows that lose nothing, so that
    their texts need not travel.
    """
    texts = docs.select(content_key(whole_text()).alias("k"), whole_text().alias("text"))
    summaries = stored(_summaries(texts, window, seed), "summaries")
    bodies = texts.select("k", packed(F.col("text")).alias("body")).dropDuplicates(["k"]).where(F.col("k").isNotNull())
    ranges = recurring_ranges(summaries, bodies, window, seed, hot)
    spans = ranges.groupBy("k").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, len(batch), 256):
                some, rows = batch.iloc[at : at + 256], []
                for k, body, spans_of in zip(some["k"], some["body"], some["spans"]):
                    words = reader.decompress(body).split()
                    keep = np.ones(len(words), dtype=bool)
                    for s in spans_of:
                        keep[s["start"] : s["stop"]] = False
                    kept = b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])
                    rows.append((k, int((~keep).sum()), kept.decode("utf-8")))
                yield pd.DataFrame(rows, columns=["k", "n_removed", "kept"])

    shortened = bodies.join(spans, "k").select("k", "body", "spans").mapInPandas(
        cut, "k binary, n_removed long, kept string"
    )
    whole = (F.col("copies") > 1) & (F.col("n_words") >= window)
    result = summaries.select("k", "copies", "n_words", "whole_sha").join(shortened, "k", "left").select(
        "k", "n_words", "whole_sha",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
    rows = docs.select("doc_id", content_key(whole_text()).alias("k"))
    return rows.join(result, "k").drop("k")
