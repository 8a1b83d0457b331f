"""Removed words against counting every window."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from actuaria.llm import repeated_passages as R
from tests.llm.helpers import SCHEMA, empty_docs, odd_docs, odd_rows, prose, with_extras


def brute(rows, size):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    count = Counter(tuple(w[a : a + size]) for _, w in split for a in range(len(w) - size + 1))
    out = []
    for i, w in split:
        keep = [True] * len(w)
        for a in range(len(w) - size + 1):
            if count[tuple(w[a : a + size])] > 1:
                keep[a : a + size] = [False] * size
        kept = b" ".join(x for x, k in zip(w, keep) if k)
        out.append((str(i), len(w), keep.count(False), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(docs, **options):
    done = R.remove_recurring(docs, **options).withColumn("sha", F.coalesce(F.sha2("kept", 256), "whole_sha"))
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["sha"]) for r in done.collect())


def rows():
    rnd, out = random.Random(6), odd_rows()
    shared = prose(41, 900).split()
    for i in range(40):  # overlapping parts of one passage, some edited
        a = rnd.randrange(800)
        part = shared[a : a + rnd.randrange(20, 100)]
        if i % 3 == 0:
            part[len(part) // 2] = "edited"
        out.append((100 + i, f"{prose(600 + i, rnd.randrange(30))} {' '.join(part)} {prose(800 + i, rnd.randrange(30))}"))
    out.append((300, " ".join([prose(42, 12)] * 8)))  # repeats within one text
    out.append((301, "same " * 50))
    out += [(310 + i, prose(43 + i, 20) + " to and fro" * 40 + prose(44 + i, 20)) for i in range(4)]
    return out


@pytest.mark.parametrize("hot", [1000, 1])
def test_matches_counting_every_window(spark, hot):
    docs = with_extras(spark.createDataFrame(rows(), SCHEMA))
    assert got(docs, hot=hot) == brute(rows(), 35)


def test_small_windows(spark):
    some = [r for r in rows() if r[1] is None or len(r[1]) < 3000]
    assert got(spark.createDataFrame(some, SCHEMA), window=5, seed=3) == brute(some, 5)


def test_odd_texts_and_empty_table(spark):
    assert got(odd_docs(spark)) == brute(odd_rows(), 35)
    assert R.remove_recurring(empty_docs(spark)).count() == 0


def test_equal_windows_keep_equal_seeds():
    finder = R.SeedFinder(35, 12)
    words = prose(51, 300).encode().split()
    hashes = finder.hashes(words)
    owners = finder.owners(hashes)
    assert (owners[1:] >= owners[:-1]).all() and set(owners) <= set(finder.places(hashes).tolist())
    inner = finder.hashes(words[100:135])
    assert finder.owners(inner)[0] + 100 == owners[100]
