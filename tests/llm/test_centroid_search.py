"""Centroid clustering against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from actuaria.llm import centroid_search as cs

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k, rounds, width, scale):
    kept = [
        (i, [scale * n // d for n, d in (float(v).as_integer_ratio() for v in x)]) for i, x in rows
        if x is not None and len(x) == width and all(v is not None and math.isfinite(v) for v in x)
    ]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    centroids = [q for _, q in order[:k]]
    if not centroids:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids)) for _, q in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centroids)):
            members = [q for (_, q), (_, c) in zip(kept, found) if c == n]
            if members:
                centroids[n] = [sum(col) // len(members) for col in zip(*members)]
    found = assign()
    out = []
    for (i, _), (d, c) in zip(kept, found):
        inertia = sum(x for x, n in found if n == c), sum(x for x, _ in found)
        d, *inertia = (v if v < 2**63 else None for v in (d, *inertia))
        out.append((i, c, d, *inertia, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()))
    return sorted(out, key=str)


def both(spark, rows, k=5, rounds=3, width=4, scale=256):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = cs.clusters(table, k, rounds, width, scale)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, k, rounds, width, scale)


def vectors(seed, n, width=4, spread=1.0):
    rnd = random.Random(seed)
    return [(i, [rnd.gauss(0, spread) + rnd.randrange(4) for _ in range(width)]) for i in range(n)]


def test_clusters_ties_and_repeats(spark):
    rows = vectors(1, 120)
    both(spark, rows + rows[:30] + [(500 + i, rows[3][1]) for i in range(200)])
    both(spark, [(i, [float(i % 3), 0.0, 0.0, 0.0]) for i in range(40)], k=8)  # equal centroids, exact ties


def test_odd_rows_and_huge_values(spark):
    odd = [
        (1, None), (2, []), (3, [1.0, None, 2.0, 3.0]), (4, [1.0, float("nan"), 2.0, 3.0]), (5, [float("inf")] * 4),
        (6, [1.0] * 5), (None, [0.5, 0.5, 0.5, 0.5]), (7, [-0.001, -0.0, 0.0, 1e-300]),
    ]
    both(spark, vectors(2, 30) + odd)
    both(spark, vectors(2, 30) + odd + [(8, [1e300, -1e300, 1e18, 5.0]), (9, [1e6, 1e7, -1e6, 0.3]), (10, [1e300] * 4)])
    both(spark, [(None, [1.0, 2.0, 3.0, 4.0])])
    both(spark, vectors(3, 3), k=10)
    both(spark, [])


def test_extra_columns_are_not_read(spark):
    rows = vectors(4, 20)
    wide = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", x int, cluster int, distance int")
    found = cs.clusters(wide, 5, 3, 4)
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, 5, 3, 4, 256)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.lists(st.integers(-40, 40), min_size=3, max_size=3), min_size=1, max_size=12),
    st.lists(st.lists(st.integers(-40, 40), min_size=3, max_size=3), min_size=1, max_size=20),
)
def test_search_equals_all_distances(centroids, rows):
    want = [min((sum((a - b) ** 2 for a, b in zip(r, c)), n) for n, c in enumerate(centroids)) for r in rows]
    ready = cs.Centroids(centroids)
    for x in (np.array(rows, dtype=np.int64), np.array(rows, dtype=object)):
        number, distance, _ = ready.nearest(x)
        assert list(zip(distance.tolist(), number.tolist())) == want


@pytest.mark.parametrize("by", ["mean", "deviation"])
def test_both_inequalities_reject(by):
    rnd = random.Random(5)
    if by == "mean":
        centroids = [[100 * c + rnd.randrange(9) for _ in range(16)] for c in range(40)]
    else:  # equal means, growing deviations
        centroids = [[(-1) ** i * 100 * c for i in range(16)] for c in range(40)]
    x = np.array([[v + rnd.randrange(5) for v in rnd.choice(centroids)] for _ in range(300)], dtype=np.int64)
    number, distance, computed = cs.Centroids(centroids).nearest(x)
    every = ((x[:, None, :] - np.array(centroids)[None]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert computed < (2.5 if by == "mean" else 24) * len(x)  # of 40 a vector
