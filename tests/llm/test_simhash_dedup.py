"""Fingerprints, links and groups against direct computation."""

import random

import numpy as np
import xxhash

from actuaria.llm import components, simhash_dedup as S
from tests.llm.helpers import empty_docs, odd_docs, odd_rows, prose, with_extras


def plain_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, k=3):
    ids = list(range(len(prints)))
    root = ids[:]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids[:a]:
            if bin(prints[a] ^ prints[b]).count("1") <= k:
                root[find(a)] = find(b)
    return [find(i) for i in ids]


def test_fingerprint_of_odd_texts():
    for text in ["", " \t", "One", "ONE two", "É é a B c", prose(5, 700), "a\x0bb\x1cc d"]:
        assert S.fingerprint(text) == plain_fingerprint(text)


def test_every_link_is_found_for_any_number_of_parts(spark):
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for b in base[:25]:
        for _ in range(6):
            x = b
            for bit in rnd.sample(range(64), rnd.randint(1, 5)):
                x ^= 1 << bit
            prints.add(x)
    hot = base[0] & ~0xFFFFFF  # many values that agree in most bits
    prints |= {hot | rnd.getrandbits(24) for _ in range(60)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    classes = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = {
        (min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]
        if bin((a ^ b) & (2**64 - 1)).count("1") <= 3
    }
    for parts in (None, 2, 3, 4):
        got = {tuple(r) for r in S.near_links(classes, 3, parts).collect()}
        assert got == want


def test_thresholds_meet_the_pigeonhole_condition():
    rnd = np.random.default_rng(1)
    for m in (2, 3, 4):
        costs = [np.column_stack([np.zeros(50), np.cumsum(rnd.random((50, 4)) * 9, axis=1)]) for _ in range(m)]
        got = S.allocate(costs, 3)
        assert (got.sum(axis=1) == 3 - m + 1).all() and got.min() >= -1
        for row in range(5):
            best = min(sum(costs[i][row, t[i] + 1] for i in range(m)) for t in S._splits(m, 3))
            assert np.isclose(sum(costs[i][row, got[row, i] + 1] for i in range(m)), best)


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[i] == 1 for i in range(2, 41)) and all(got[100 + i] == 100 for i in range(1, 30)) and got[201] == 200
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_groups_of_odd_documents(spark):
    rows = odd_rows()
    prints = [plain_fingerprint(t) for _, t in rows]
    root = groups(prints)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, root))
    got = S.near_duplicate_groups(odd_docs(spark)).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == want


def test_one_row_of_each_group_stays_with_all_columns(spark):
    docs = with_extras(odd_docs(spark))
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    root = groups([plain_fingerprint(t) for _, t in odd_rows()])
    assert len(rows) == len(set(root))
    assert {r["doc_id"] for r in rows} >= {1, 4, 5, 12} and 6 not in {r["doc_id"] for r in rows}
    assert S.drop_near_duplicates(empty_docs(spark)).count() == 0
    assert S.near_duplicate_groups(empty_docs(spark)).count() == 0
