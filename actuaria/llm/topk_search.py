"""Exact top-k inner-product search by block-at-a-time pruning.

1. *Blocks.* Vectors are dealt by range (cluster of the vector, then vec_id) into shards; a
   shard's rows in that order are cut into blocks of ``BLOCK`` vectors. A block row holds
   its forward index (ids and the integer matrix) and, per term, the largest and the smallest value.
2. *Bounds.* For a query, a block's bound is the sum over the terms of the larger of
   weight x largest and weight x smallest value: no vector of the block can score more.
3. *Search.* Each query visits the blocks of a shard in falling order of their bounds and
   scores them through their forward index until the bound of the next block is below its
   k-th best score (a block whose bound equals it is still visited: a tie may
   go to a smaller vec_id).
4. *Floors.* A query's k-th best score so far is a floor for all shards: blocks whose bound is below
   it are not scored and vectors below it are not given out. The first floor comes from
   a bounded sample of vectors; then the shards are searched in rounds, twice as many each time,
   and every round's best k, kept with those before, raise the floors of the next. So a query gives about
   k rows a round, however many shards there are.

Queries are dealt in groups, and every (shard, query group) pair is one task's work of
bounded size: a block nested loop over a stated query set. Only the sample is sent to all tasks, and the
order of blocks and shards only affects the time, never the rows.

Defined results: vectors null, or holding null or non-finite components, and rows without
vec_id take no part; shorter vectors count as zero-padded; rows equal in vec_id and vector
count once; of a vec_id with different vectors each is a candidate, and the smallest vector
is the query; fewer than k candidates give fewer rows; an empty table gives an empty result.
Components whose products could leave 64-bit integers raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actuaria.llm.common import hash_sample, stored

BLOCK = 64
SHARD = 16_384  # vectors
QUERY_GROUP = 512
PIVOTS = 64  # directions whose best match orders the vectors before they are cut into blocks
PIVOT_SAMPLE = 4096
FIRST_ROUND = 8  # shards


def integer_vectors(table: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and its components floor(scale * x), for the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = table.select("vec_id", x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    return rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))).select(
        "vec_id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("q")
    )


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _sample(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer components of a bounded sample of the vectors."""
    sample = hash_sample(vectors, ["vec_id", "q"], PIVOT_SAMPLE).collect()
    rows = sorted({(r["vec_id"], tuple(r["q"])) for r in sample})  # equal rows are one candidate
    ids = np.array([i for i, _ in rows], dtype=np.int64)
    return ids, _matrix([q for _, q in rows], max((len(q) for _, q in rows), default=0))


def _pivots(sample: np.ndarray) -> np.ndarray:
    """Cluster directions from the sample (they set the block order, not the result)."""
    if not len(sample):
        return np.zeros((1, 0))
    x = sample.astype(float)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = x[:PIVOTS].copy()
    for _ in range(8):
        best = (x @ centres.T).argmax(1)
        for c in range(len(centres)):
            if (best == c).any():
                centres[c] = x[best == c].mean(0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return centres


def block_index(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Rows (shard, ids, width, matrix, top, low): blocks of vectors near each other."""
    n = vectors.count()
    shards = max(1, -(-n // SHARD))

    def cluster(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            x = _matrix(list(values), max([centres.shape[1], *map(len, values)])).astype(float)
            yield pd.Series((x[:, : centres.shape[1]] @ centres.T).argmax(1).astype(np.int32))

    placed = vectors.withColumn("c", F.pandas_udf(cluster, "int")("q"))
    dealt = placed.repartitionByRange(shards, "c", "vec_id", "q").sortWithinPartitions("c", "vec_id", "q")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, rows, last = [], [], None

        def block() -> pd.DataFrame:
            width = max(map(len, rows))
            m = _matrix(rows, width)
            return pd.DataFrame(
                {
                    "ids": [np.array(ids, dtype="<i8").tobytes()], "width": [width], "matrix": [m.astype("<i8").tobytes()],
                    "top": [m.max(0).astype("<i8").tobytes()], "low": [m.min(0).astype("<i8").tobytes()],
                }
            )

        for batch in batches:
            for i, q in zip(batch["vec_id"], batch["q"]):
                this = (i, tuple(q))
                if this == last:
                    continue  # a repeated row: equal rows are neighbours here
                last = this
                ids.append(i)
                rows.append(q)
                if len(ids) == BLOCK:
                    yield block()
                    ids, rows = [], []
        if ids:
            yield block()

    made = dealt.mapInPandas(blocks, "ids binary, width int, matrix binary, top binary, low binary")
    return made.withColumn("shard", F.spark_partition_id())


def search_shard(query_ids, queries: np.ndarray, blocks: list[tuple], k: int, floors: np.ndarray | None = None) -> list[tuple]:
    """Best k (query_id, vec_id, score) of each query over a shard's blocks, pruned exactly.

    ``blocks`` holds (ids, matrix, top, low). ``floors`` are scores that k candidates of each query
    are known to reach elsewhere: what scores less is not given (a tie may go to a smaller vec_id, so it is). All queries advance together: in each round a
    query scores its next blocks by falling bound, twice as many each time, and stops as
    soon as the next bound is below its k-th best score.
    """
    width = max([queries.shape[1], *(b[1].shape[1] for b in blocks)])
    queries = _widen(queries, width)
    top, low = (np.stack([_widen(b[i][None, :], width)[0] for b in blocks]) for i in (2, 3))
    mats = [_widen(b[1], width) for b in blocks]
    limit = float(np.abs(queries).max(initial=0)) * max(float(np.abs(m).max(initial=0)) for m in mats) * max(width, 1)
    if limit >= 2.0**62:
        raise ArithmeticError("vector components are too large for 64-bit scores")
    kind = np.float64 if limit < 2.0**53 else np.int64  # sums below 2^53 are exact in doubles
    queries, mats = queries.astype(kind), [m.astype(kind) for m in mats]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = up @ top.T.astype(kind) + down @ low.T.astype(kind)
    order = np.argsort(-bounds, axis=1, kind="stable")
    ranked = np.take_along_axis(bounds, order, axis=1)
    none = np.iinfo(np.int64).min
    best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in query_ids]  # scores, ids
    given = np.full(len(query_ids), float("-inf")) if floors is None else floors.astype(float)
    floor = given.copy()
    active, at, step = np.flatnonzero(ranked[:, 0] >= floor) if len(blocks) else np.arange(0), 0, 1
    while len(active) and at < len(blocks):
        stop = min(at + step, len(blocks))
        by_block: dict[int, list[int]] = {}
        for q in active:
            for r in range(at, stop):
                if ranked[q, r] < floor[q]:
                    break
                by_block.setdefault(int(order[q, r]), []).append(q)
        fresh: dict[int, list[tuple]] = {}
        for b, who in by_block.items():
            scores = queries[who] @ mats[b].T
            for row, q in zip(scores, who):
                fresh.setdefault(q, []).append((row, blocks[b][0]))
        for q, found in fresh.items():
            score = np.concatenate([best[q][0], *(f[0].astype(np.int64) for f in found)])
            ids = np.concatenate([best[q][1], *(f[1] for f in found)])
            keep = ids != query_ids[q]
            score, ids = score[keep], ids[keep]
            pick = np.lexsort((ids, -score))[:k]
            best[q] = (score[pick], ids[pick])
            if len(pick) == k:
                floor[q] = max(floor[q], best[q][0][-1])
        at, step = stop, step * 2
        if at < len(blocks):
            active = active[ranked[active, at] >= floor[active]]
    return [
        (int(query_ids[q]), int(i), int(s))
        for q in range(len(query_ids)) for s, i in zip(*best[q]) if s != none and s >= given[q]
    ]


def _widen(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def top_k(table: DataFrame, is_query, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of each query.

    ``is_query`` is a Column over vec_id; every row but the query's own is a candidate.
    """
    vectors = integer_vectors(table, scale)
    sample_ids, sample = _sample(vectors)
    index = stored(block_index(vectors, _pivots(sample)), "blocks")
    asked = vectors.where(is_query).groupBy("vec_id").agg(F.min("q").alias("q"))
    asked = stored(asked.mapInPandas(_first_floors(sample_ids, sample, k), "vec_id long, q array<long>, floor double"), "queries")
    groups = max(1, -(-asked.count() // QUERY_GROUP))
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    group = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("group")

    def search(blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(blocks) or not len(queries):
            return pd.DataFrame([], columns=names).astype("int64")
        ready = [
            (
                np.frombuffer(b.ids, "<i8"), np.frombuffer(b.matrix, "<i8").reshape(-1, b.width) if b.width else np.zeros((len(b.ids) // 8, 0), np.int64),
                np.frombuffer(b.top, "<i8"), np.frombuffer(b.low, "<i8"),
            )
            for b in blocks.itertuples()
        ]
        m = _matrix(list(queries["q"]), max(map(len, queries["q"])))
        found = search_shard(queries["vec_id"].to_numpy(), m, ready, k, queries["floor"].to_numpy())
        return pd.DataFrame(found, columns=names).astype("int64")

    def searched(queries: DataFrame, first: int, last: int) -> DataFrame:
        # every query group meets every shard of the round; one such pair is the unit of work
        chosen = index.withColumn("turn", _turn(shards)).where(F.col("turn").between(first, last))
        left = chosen.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        right = queries.select("vec_id", "q", "floor", group).withColumn(
            "turn", F.explode(F.sequence(F.lit(first), F.lit(last)))
        )
        return (
            left.groupBy("turn", "group").cogroup(right.groupBy("turn", "group"))
            .applyInPandas(search, "query_id long, vec_id long, score long")
        )

    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best, queries, first, size = None, asked, 0, FIRST_ROUND
    while first < shards:
        last = min(first + size, shards) - 1
        found = searched(queries, first, last)
        found = found if best is None else best.unionByName(found)
        best = found.withColumn("rank", order).where(F.col("rank") <= k)
        first, size = last + 1, 2 * size
        if first < shards:
            best = stored(best.drop("rank"), "best")
            # a query with k candidates has their least score as its floor
            reached = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
            reached = reached.where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "least")
            raised = F.greatest("floor", F.coalesce("least", F.col("floor")))
            queries = stored(asked.join(reached, "vec_id", "left").select("vec_id", "q", raised.alias("floor")), "queries")
    return best.select("query_id", "rank", "vec_id", "score")


def _turn(shards: int):
    """A shard's turn: neighbours, which hold vectors near each other, come in different rounds."""
    step = max(1, int(shards * 0.618))
    while np.gcd(step, shards) != 1:
        step += 1
    return F.pmod(F.col("shard").cast("long") * F.lit(step), F.lit(shards)).cast("int")


def _first_floors(ids: np.ndarray, sample: np.ndarray, k: int):
    """Adds each query's k-th best score over the sample (minus infinity where it has fewer)."""

    def floors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for at in range(0, len(batch), 256):
                some = batch.iloc[at : at + 256]
                width = max([sample.shape[1], *map(len, some["q"])])
                q, rows = _matrix(list(some["q"]), width), _widen(sample, width)
                limit = float(np.abs(q).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(width, 1)
                if limit >= 2.0**53 or len(ids) <= k:  # no exact doubles, or too few: no floor
                    found += [float("-inf")] * len(some)
                    continue
                scores = q.astype(float) @ rows.T.astype(float)
                scores[some["vec_id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
                found += np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k].tolist()
            yield batch.assign(floor=found)

    return floors
