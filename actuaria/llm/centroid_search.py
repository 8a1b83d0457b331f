"""Integer k-means with equal-average equal-variance nearest-centroid search.

Components become integers, so every distance and every mean is exact. The centroids are sorted
by the sum of their components. A vector starts at its own sum's place in that order and looks
outwards, the nearer side first. With ``width`` components, sums S and spreads V (the length of the part
that is left after the mean is taken off, times the root of ``width``):

* *mean*: ``width * distance >= (Sx - Sc)**2``. Where this exceeds ``width`` times the best
  distance, everything further out is rejected at once and the search of the vector ends;
* *deviation*: ``width * distance >= (Sx - Sc)**2 + (Vx - Vc)**2`` rejects a single centroid. V is a
  floating-point number here, so the bound is taken a little lower than computed;
* what is left gets its exact integer distance; ties go to the smaller centroid number, and a bound equal to
  the best distance rejects nothing.

Vectors are never shuffled. A round is one scan: each task searches its vectors and adds up
the members of each centroid, and only those sums (centroids x components) are
aggregated. The driver holds the centroids and their sums, bounded by ``k`` and ``width``.

Defined results: vectors null, of another length, or holding null or non-finite components take
no part; rows without vec_id are clustered but are never first centroids; repeated rows count
each; equal hashes (repeated vec_id) are ordered by the components, equal ones are each
a centroid, of which the smaller number takes all members and the other stays as it is; fewer vectors than ``k`` give as many
centroids; an empty table gives an empty result; other columns are not read.
Components of any finite size are searched exactly: those beyond 2^24 after scaling in
unbounded integers (slower). A distance or a sum of distances beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import stored

K, ROUNDS, WIDTH, SCALE = 40, 5, 64, 256
NARROW = 1 << 24  # up to here every product below fits 64-bit integers
LIMB = 10**18
ROWS = 4096  # vectors searched at a time


def kept_vectors(table: DataFrame, width: int = WIDTH) -> DataFrame:
    """vec_id and the components x (double) of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = table.select("vec_id", x.alias("x")).where(F.size("x") == width)
    return rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def integers(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit integers where all are narrow, Python integers otherwise."""
    if not rows.size or np.abs(rows).max() <= NARROW / scale - 1:
        return np.floor(rows * scale).astype(np.int64)

    def exact(v: float) -> int:
        top, bottom = v.as_integer_ratio()
        return scale * top // bottom

    return np.array([[exact(v) for v in row] for row in rows.tolist()], dtype=object)


class Centroids:
    """Centroids sorted by the sum of their components, ready for the search."""

    def __init__(self, numbered: list[list[int]]):
        wide = any(abs(v) > NARROW for c in numbered for v in c)
        every = np.array(numbered, dtype=object if wide else np.int64)
        sums = every.sum(1)
        self.number = np.array(sorted(range(len(numbered)), key=lambda i: (sums[i], i)), dtype=np.int64)
        self.rows, self.sums, self.wide = every[self.number], sums[self.number], wide
        self.spread = _spread(self.rows, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's nearest centroid; distances computed."""
        if x.dtype == object or self.wide:
            return self._nearest_wide(x)
        k, width = self.rows.shape
        sums = x.sum(1)
        spread = _spread(x, sums)
        # sums from -limit to limit stand at both ends, so that no side runs out of places
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(len(x), np.iinfo(np.int64).max // width, dtype=np.int64)
        number = np.full(len(x), k, dtype=np.int64)
        alive, computed = np.arange(len(x)), 0
        far = np.int64(1) << 40
        while len(alive):
            lo, hi, s = left[alive], right[alive], sums[alive]
            below = np.where(lo >= 0, s - self.sums[np.maximum(lo, 0)], far)
            above = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - s, far)
            down = below <= above
            gap = np.where(down, below, above)
            # the nearer side is too far or both have run out: nothing further out can be nearer
            open_ = (gap < far) & (np.minimum(gap, 1 << 31) ** 2 <= width * best[alive])
            alive, gap, down = alive[open_], gap[open_], down[open_]
            place = np.where(down, left[alive], right[alive])
            left[alive[down]] -= 1
            right[alive[~down]] += 1
            off = np.abs(spread[alive] - self.spread[place])
            off = np.maximum(off - 1e-6 * (spread[alive] + self.spread[place]), 0.0)
            near = (gap.astype(float) ** 2 + off**2) * (1 - 1e-9) <= width * best[alive].astype(float) * (1 + 1e-9)
            rows, place = alive[near], place[near]
            step = x[rows] - self.rows[place]
            distance = np.einsum("ij,ij->i", step, step)
            computed += len(rows)
            named = self.number[place]
            better = (distance < best[rows]) | ((distance == best[rows]) & (named < number[rows]))
            best[rows[better]], number[rows[better]] = distance[better], named[better]
        return number, best, computed

    def _nearest_wide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The same search in unbounded integers; V is rounded down, so its bound is exact too."""
        k, width = self.rows.shape
        centroids, centroid_sums = self.rows.tolist(), [int(s) for s in self.sums]
        spread = [_whole_spread(c) for c in centroids]
        numbers, distances, computed = [], [], 0
        for v in x.tolist():
            s, own, best = sum(v), _whole_spread(v), None
            for i in sorted(range(k), key=lambda i: abs(s - centroid_sums[i])):
                gap = abs(s - centroid_sums[i])
                if best and gap * gap > width * best[0]:
                    break
                off = max(abs(own - spread[i]) - 1, 0)
                if best and gap * gap + off * off > width * best[0]:
                    continue
                distance = sum((a - b) ** 2 for a, b in zip(v, centroids[i]))
                computed += 1
                found = (distance, int(self.number[i]))
                best = found if best is None else min(best, found)
            numbers.append(best[1])
            distances.append(best[0])
        return np.array(numbers, dtype=np.int64), np.array(distances, dtype=object), computed


def _spread(rows: np.ndarray, sums: np.ndarray) -> np.ndarray:
    if rows.dtype == object:
        return np.zeros(len(rows))
    mean = sums.astype(float) / rows.shape[1]
    return np.sqrt(rows.shape[1] * ((rows - mean[:, None]) ** 2).sum(1))


def _whole_spread(v: list[int]) -> int:
    return isqrt(max(len(v) * sum(a * a for a in v) - sum(v) ** 2, 0))


def _blocks(batches: Iterator[pd.DataFrame], scale: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows and their integer components; narrow and wide vectors never share a block."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            some = batch.iloc[at : at + ROWS]
            x = np.array(some["x"].tolist(), dtype=float)
            narrow = np.abs(x).max(1) <= NARROW / scale - 1
            for part in (narrow, ~narrow):
                if part.any():
                    yield some[part], integers(x[part], scale)


def first_centroids(vectors: DataFrame, k: int, scale: int = SCALE) -> list[list[int]]:
    """The ``k`` vectors of the smallest SHA-256 of ``2:<vec_id>``."""
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where(F.col("vec_id").isNotNull()).orderBy(order, "x").limit(k).select("x").collect()
    return [[int(v) for v in integers(np.array([r["x"]], dtype=float), scale)[0]] for r in rows]


def _member_sums(vectors: DataFrame, numbered: list[list[int]], scale: int) -> list[list[int]]:
    """The centroids of the next round; those without members stay."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = Centroids(numbered)
        total = [[0] * len(c) for c in numbered]
        count = [0] * len(numbered)
        for _, x in _blocks(batches, scale):
            number, _, _ = ready.nearest(x)
            for c in np.unique(number).tolist():
                members = x[number == c]
                count[c] += len(members)
                total[c] = [a + int(b) for a, b in zip(total[c], members.sum(0))]
        rows = []
        for c, n in enumerate(count):
            if n:
                rows.append((c, -1, 0, n))
            for p, value in enumerate(total[c]):
                sign, rest, limb = (-1 if value < 0 else 1), abs(value), 0
                while rest:
                    rest, low = divmod(rest, LIMB)
                    rows.append((c, p, limb, sign * low))
                    limb += 1
        yield pd.DataFrame(rows, columns=["cluster", "place", "limb", "part"])

    parts = vectors.select("x").mapInPandas(sums, "cluster int, place int, limb int, part long")
    summed = parts.groupBy("cluster", "place", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    count: dict[int, int] = {}
    total: dict[tuple[int, int], int] = {}
    for r in summed.collect():  # at most k x (width + 1) x limbs of a double (18)
        if r["place"] < 0:
            count[r["cluster"]] = int(r["part"])
        else:
            key = r["cluster"], r["place"]
            total[key] = total.get(key, 0) + int(r["part"]) * LIMB ** r["limb"]
    return [
        [total.get((c, p), 0) // count[c] for p in range(len(old))] if c in count else old
        for c, old in enumerate(numbered)
    ]


def clusters(
    table: DataFrame, k: int = K, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept row."""
    vectors = kept_vectors(table, width)
    numbered = first_centroids(vectors, k, scale)
    for _ in range(rounds if numbered else 0):
        numbered = _member_sums(vectors, numbered, scale)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = Centroids(numbered) if numbered else None
        for rows, x in _blocks(batches, scale):
            if ready is None:  # only rows without vec_id: no centroid
                continue
            number, distance, _ = ready.nearest(x)
            yield pd.DataFrame({"vec_id": rows["vec_id"], "cluster": number, "distance": [str(d) for d in distance]})

    found = vectors.select(F.col("vec_id").cast("string"), "x").mapInPandas(assign, "vec_id string, cluster int, distance string")
    found = stored(found.withColumn("distance", F.col("distance").try_cast("bigint")), "clusters")
    inertia = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)"))).try_cast("bigint")
    per = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(inertia.alias("inertia")).collect()}  # k rows
    whole = found.agg(inertia.alias("inertia")).first()["inertia"]
    names = [
        (c, per.get(c), whole, hashlib.sha256(",".join(map(str, q)).encode()).hexdigest()) for c, q in enumerate(numbered)
    ]
    named = table.sparkSession.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(  # k rows
        F.col("vec_id").cast(table.schema["vec_id"].dataType).alias("vec_id"), "cluster", "distance", "cluster_inertia",
        "inertia", "centroid_sha256",
    )
