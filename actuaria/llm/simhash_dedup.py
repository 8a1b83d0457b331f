"""SimHash near-duplicates, linked by a generalised pigeonhole search.

1. *Fingerprints.* A text is lower-cased in A-Z, cut into words and word shingles; bit b of
   its 64-bit fingerprint is 1 when bit b is set in over half of the shingles' XXH64 values.
2. *Classes.* Rows with one fingerprint form a class (a map-side combined aggregate), so
   thousands of copies become one row before any pair is looked for.
3. *Partitions.* The bits are grouped so that correlated bits share a partition
   (:func:`group_bits`, from a 64x64 correlation table of fixed size).
4. *Thresholds.* With m partitions two fingerprints within distance k agree to within
   t_i bits in some partition i whenever the t_i (each at least -1, where -1 means "do not
   probe") add up to k - m + 1. For every fingerprint a dynamic programme over the
   partitions picks the t_i of the least estimated work: the probes sent plus the
   candidates they meet, estimated from the frequent values of each partition.
5. *Probe and verify.* Each class sends its probes to an equi-join on (partition, value)
   and the candidates' bit distance is checked exactly.
6. *Components* of the verified links give the groups.

No step gathers a group: frequent partition values are what the thresholds steer away
from, and the join may be split by adaptive execution.

Defined results: null or word-less text has fingerprint 0 and is linked like any other;
fewer words than a shingle form one shingle; repeated rows are rows of one class; a null
doc_id never becomes a component id while its component has another one. Empty table:
empty result. Columns other than doc_id and text are not read by the search.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import content_key, fresh_name, stored, whole_text
from actuaria.llm.components import connected_components

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
# A partition value is "frequent" when it holds over 1/FREQUENT_SHARE of the classes, so
# at most FREQUENT_SHARE values a partition are ever listed.
FREQUENT_SHARE = 2000


# ---- fingerprints -----------------------------------------------------------------
def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, as an unsigned 64-bit number."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    total = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    # bounded steps, so that a very long text needs no more memory than a long one
    for at in range(0, n, 65536):
        part = words[at : min(at + 65536, n) + shingle_words - 1]
        rows = zip(*(part[i:] for i in range(min(shingle_words, len(words))))) if n > 1 else [part]
        hashes = np.array([digest(b" ".join(r), SEED) for r in rows], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, column: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed 64-bit column."""

    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.fromiter((fingerprint(t, shingle_words) for t in texts), dtype=np.uint64, count=len(texts))
            yield pd.Series(values.view(np.int64))

    return docs.withColumn(column, F.pandas_udf(prints, "long")(whole_text()))


# ---- partitions and thresholds ------------------------------------------------------
def bit_correlation(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of classes and the absolute correlation of every two bits (64 x 64)."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy(np.int64)).astype(np.float32)
            for at in range(0, len(bits), 1 << 16):
                part = bits[at : at + (1 << 16)]
                both += part.T @ part
            n += len(bits)
        yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1), "n": np.append(both.ravel(), n).astype(np.int64)})

    cells = classes.select("fp").mapInPandas(counts, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = np.zeros(BITS * BITS + 1)
    for row in cells.collect():  # always 4097 rows
        table[row["cell"]] = row["n"]
    n = int(table[-1])
    if n < 2:
        return n, np.zeros((BITS, BITS))
    joint = table[:-1].reshape(BITS, BITS) / n
    mean = np.diag(joint)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return n, np.abs((joint - np.outer(mean, mean)) / np.outer(spread, spread))


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits 0..63 in ``parts`` groups of near-equal size, correlated bits together.

    Each group starts from the most correlated pair left and takes in the bit with the
    highest mean correlation to its members until it is full.
    """
    left, groups = list(range(BITS)), []
    sizes = [BITS // parts + (i < BITS % parts) for i in range(parts)]
    for size in sizes:
        if size == len(left):
            groups.append(sorted(left))
            break
        a, b = max(combinations(left, 2), key=lambda p: (correlation[p], -p[0], -p[1]))
        group = [a, b]
        left = [x for x in left if x not in (a, b)]
        while len(group) < size:
            nxt = max(left, key=lambda x: (correlation[x, group].mean(), -x))
            group.append(nxt)
            left.remove(nxt)
        groups.append(sorted(group))
    return groups


def ball_masks(width: int, radius: int) -> np.ndarray:
    """XOR masks of every value within ``radius`` bits, for a value of ``width`` bits."""
    masks = [0]
    for r in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(width), r)]
    return np.array(masks, dtype=np.int64)


def choose_parts(n: int, k: int) -> int:
    """Number of partitions with the least work a class, for evenly spread values."""

    def work(m: int) -> float:
        widths = [BITS // m + (i < BITS % m) for i in range(m)]
        best = min(_splits(m, k), key=lambda t: sum(_ball(w, r) for w, r in zip(widths, t)))
        probes = sum(_ball(w, r) for w, r in zip(widths, best))
        return probes + 0.1 * sum(_ball(w, r) * n / 2.0**w for w, r in zip(widths, best))

    return min(range(2, k + 2), key=work) if k else 1


def _ball(width: int, radius: int) -> int:
    return len(ball_masks(width, radius)) if radius >= 0 else 0


def _splits(m: int, k: int):
    """Threshold vectors of m parts, each -1..k, adding up to k - m + 1."""

    def rest(parts: int, total: int):
        if parts == 1:
            if -1 <= total <= k:
                yield (total,)
            return
        for t in range(-1, k + 1):
            for tail in rest(parts - 1, total - t):
                yield (t, *tail)

    return list(rest(m, k - m + 1))


def allocate(costs: list[np.ndarray], k: int) -> np.ndarray:
    """Least-cost thresholds of every row, by dynamic programming over the partitions.

    ``costs[i][:, t + 1]`` is the estimated work of threshold t in partition i (t = -1..k).
    Returns an array (rows, partitions) whose rows add up to k - m + 1.
    """
    m, rows = len(costs), len(costs[0])
    budget = k + 1  # thresholds shifted by one: each 0..k+1, adding up to k + 1
    best = np.full((rows, budget + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((m, rows, budget + 1), dtype=np.int8)
    for i in range(m):
        nxt = np.full((rows, budget + 1), np.inf)
        for used in range(budget + 1):
            for t in range(used + 1):
                value = best[:, used - t] + costs[i][:, t]
                better = value < nxt[:, used]
                nxt[better, used] = value[better]
                choice[i, better, used] = t
        best = nxt
    out, used = np.zeros((rows, m), dtype=np.int64), np.full(rows, budget)
    for i in range(m - 1, -1, -1):
        t = choice[i, np.arange(rows), used]
        out[:, i] = t.astype(np.int64) - 1
        used = used - t
    return out


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def partition_values(fps: np.ndarray, groups: list[list[int]]) -> list[np.ndarray]:
    bits = _bits(np.ascontiguousarray(fps, dtype="<i8")).astype(np.int64)
    return [bits[:, g] @ (1 << np.arange(len(g), dtype=np.int64)) for g in groups]


def _estimates(values: np.ndarray, width: int, k: int, n: int, frequent: dict[int, int]) -> np.ndarray:
    """Estimated work (probes and a tenth of the candidates) for thresholds -1..k."""
    even = n / 2.0**width
    known = np.array(sorted(frequent), dtype=np.int64)
    counts = np.array([frequent[v] for v in known.tolist()], dtype=float)
    out = np.zeros((len(values), k + 2))
    for t in range(k + 1):
        ball = _ball(width, t)
        out[:, t + 1] = ball + 0.1 * ball * even
    if len(known):
        distinct, back = np.unique(values, return_inverse=True)
        for at in range(0, len(distinct), 4096):
            near = np.bitwise_count(distinct[at : at + 4096, None] ^ known[None, :])
            extra = np.stack([np.zeros(len(near))] + [(counts * (near <= t)).sum(1) for t in range(k + 1)], axis=1)
            rows = (back >= at) & (back < at + 4096)
            out[rows] += 0.1 * extra[back[rows] - at]
    return out


def _frequent_values(classes: DataFrame, groups: list[list[int]], n: int) -> list[dict[int, int]]:
    """Per partition, the values held by over n / FREQUENT_SHARE classes (a bounded list)."""

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = partition_values(batch["fp"].to_numpy(np.int64), groups)
            yield pd.concat(
                [pd.DataFrame({"part": np.int32(i), "value": v}) for i, v in enumerate(parts)]
            )

    least = max(8, n // FREQUENT_SHARE)
    rows = (
        classes.select("fp").mapInPandas(values, "part int, value long")
        .groupBy("part", "value").count().where(F.col("count") > least).collect()
    )
    out: list[dict[int, int]] = [{} for _ in groups]
    for row in rows:
        out[row["part"]][row["value"]] = row["count"]
    return out


def near_links(classes: DataFrame, max_distance: int = MAX_DISTANCE, parts: int | None = None) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints at ``max_distance`` or fewer bits.

    ``classes`` has one row per distinct fingerprint in column ``fp``. Every link is found:
    the thresholds of ``u`` alone already meet the pigeonhole condition for each ``v``.
    """
    n, correlation = bit_correlation(classes)
    parts = parts or choose_parts(n, max_distance)
    groups = group_bits(correlation, parts)
    frequent = _frequent_values(classes, groups, n)
    k = max_distance

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            for i, values in enumerate(partition_values(fps, groups)):
                yield pd.DataFrame({"part": np.int32(i), "value": values, "v": fps})

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            values = partition_values(fps, groups)
            costs = [_estimates(v, len(g), k, n, f) for v, g, f in zip(values, groups, frequent)]
            thresholds = allocate(costs, k)
            for i, group in enumerate(groups):
                for t in range(k + 1):
                    rows = np.flatnonzero(thresholds[:, i] == t)
                    masks = ball_masks(len(group), t)
                    step = max(1, 200_000 // len(masks))
                    for at in range(0, len(rows), step):
                        some = rows[at : at + step]
                        yield pd.DataFrame(
                            {
                                "part": np.int32(i),
                                "value": (values[i][some, None] ^ masks[None, :]).ravel(),
                                "u": np.repeat(fps[some], len(masks)),
                            }
                        )

    left = classes.select("fp").mapInPandas(probes, "part int, value long, u long")
    right = classes.select("fp").mapInPandas(index, "part int, value long, v long")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= k
    return left.join(right, ["part", "value"]).where((F.col("u") < F.col("v")) & close).select("u", "v").distinct()


# ---- groups -------------------------------------------------------------------------
def near_duplicate_groups(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of ``max_distance`` bits.
    """
    prints = stored(with_fingerprint(docs.select("doc_id", "text"), "fp", shingle_words).select("doc_id", "fp"), "prints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected_components(near_links(classes, max_distance))
    named = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    member = named.join(heads, "root").select("fp", "component_id")
    return prints.join(member, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, all columns kept.

    The row with the smallest doc_id of the group stays; of rows that share that doc_id the
    one with the smallest content key, and of rows equal in doc_id and text any one. Rows
    without a doc_id stay only in a group that has no other row.
    """
    key = fresh_name(docs, "_row_key")
    row_key = content_key(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), whole_text()))
    thin = stored(
        with_fingerprint(docs.select("doc_id", "text"), "fp", shingle_words).select(
            "doc_id", row_key.alias("k"), "fp"
        ),
        "rows",
    )
    classes = stored(thin.groupBy("fp").agg(F.count("*").alias("n")), "classes")
    roots = connected_components(near_links(classes.select("fp"), max_distance))
    member = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k")
    heads = thin.join(member, "fp").groupBy("root").agg(F.min(order).alias("head")).select(F.col("head.k").alias(key))
    kept = docs.withColumn(key, row_key).join(heads, key, "left_semi")
    return kept.dropDuplicates([key]).select(*docs.columns)
