"""Block-pruned search against scoring every pair."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from actuaria.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, divisor, k):
    seen = set()
    ready = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(64 * float(np.float32(x)))) for x in v)
        if (i, q) not in seen:
            seen.add((i, q))
            ready.append((i, q))
    queries = {}
    for i, q in ready:
        if i % divisor == 0:
            queries[i] = min(queries.get(i, q), q)
    out = []
    for i, q in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ready if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, divisor, k):
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = topk_search.top_k(table, F.col("vec_id") % divisor == 0, k)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("first, sample", [(8, 4096), (1, 30), (2, 4)])
def test_matches_brute_force_with_ties_nulls_and_repeats(spark, monkeypatch, first, sample):
    monkeypatch.setattr(topk_search, "FIRST_ROUND", first)
    monkeypatch.setattr(topk_search, "PIVOT_SAMPLE", sample)
    monkeypatch.setattr(topk_search, "BLOCK", 8)
    monkeypatch.setattr(topk_search, "SHARD", 30)
    monkeypatch.setattr(topk_search, "QUERY_GROUP", 7)
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([-1.0, -0.3, 0.0, 0.26, 0.9]) for _ in range(5)]) for i in range(150)]
    rows += [rows[20], rows[20], (7, rows[8][1])]  # repeated rows, and one id with two vectors
    rows += [(None, [1.0] * 5), (201, None), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5)]
    rows += [(204, [float("inf")] + [0.0] * 4), (205, []), (206, [1.0, 1.0])]
    assert run(spark, rows, 10, 6) == brute(rows, 10, 6)


def test_fewer_candidates_than_k_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [1.0, -1.0])]
    assert run(spark, rows, 2, 20) == brute(rows, 2, 20)
    assert run(spark, [], 2, 20) == []
    assert run(spark, [(1, [1.0])], 2, 20) == []


def test_pruning_skips_blocks_without_changing_the_answer():
    rnd = np.random.default_rng(0)
    blocks, scored = [], []
    for b in range(20):
        m = rnd.integers(-5, 5, (16, 8)) + 40 * (b == 3)
        blocks.append((np.arange(16) + 16 * b, m, m.max(0), m.min(0)))
        scored.append(m)
    q = np.full((1, 8), 3)
    found = topk_search.search_shard(np.array([-1]), q, blocks, 4)
    every = np.concatenate(scored) @ q[0]
    order = np.lexsort((np.arange(len(every)), -every))[:4]
    assert found == [(-1, int(i), int(every[i])) for i in order]
    assert all(i // 16 == 3 for _, i, _ in found)


def test_scores_beyond_64_bits_are_refused():
    big = np.array([[1 << 40]])
    with pytest.raises(ArithmeticError):
        topk_search.search_shard(np.array([0]), big, [(np.array([1]), big, big[0], big[0])], 1)


def test_floors_of_other_shards_hold_rows_back():
    rng = np.random.default_rng(1)
    m = rng.integers(-9, 9, (400, 8))
    blocks = [(np.arange(a, a + 20), m[a : a + 20], m[a : a + 20].max(0), m[a : a + 20].min(0)) for a in range(0, 400, 20)]
    q = rng.integers(-9, 9, (3, 8))
    ids = np.array([-1, -2, -3])
    scores = m @ q.T
    floors = np.sort(scores, axis=0)[-4].astype(float)  # four reach it, ties more
    found = topk_search.search_shard(ids, q, blocks, 6, floors)
    for i in range(3):
        every = sorted((-int(s), j) for j, s in enumerate(scores[:, i]) if s >= floors[i])[:6]
        assert [(-s, j) for who, j, s in found if who == ids[i]] == every
