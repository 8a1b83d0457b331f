"""Exact per-group median that never gathers a group's values into one task.

``percentile_cont(0.5)`` in Spark keeps every distinct value of a group in one
aggregation buffer; when one group holds a third of all rows that buffer is a third
of the data in one task. This operator finds the middle order statistics by radix
selection instead, with plain DataFrame operations:

* For each digit (at most 17 bits) of the value, most significant first, a histogram
  ``(group, digit) -> (count, min value)`` over the rows still matching the chosen
  prefix. It is map-side combined, so a hot group is spread over all map tasks and
  a group never has more than 2^17 histogram rows.
* A running sum over the digits of each group picks the digit that holds the target
  rank ``floor((n - 1) / 2)``; the group size ``n`` is the histogram total of the
  first pass. ``lead(min)`` keeps, at every level, the smallest value of the next
  non-empty bucket: the upper middle value (even ``n``) is the same value when it
  repeats, else the nearest such successor. No extra pass is needed for it.

Passes: ``ceil(bits / 17)`` where ``bits`` covers the global value range (one small
min/max aggregate fixes the digit plan; money up to ~1.7e8 in cents needs 2 passes).
The first pass needs no join; later ones join the small per-group state (one row per
group) back to the rows. The state is written first, so that the planner knows its size
before it plans the join: it broadcasts a small one and the rows are not shuffled, else
it takes a skew-split shuffle join. (Of a lazy state it learns the size only when the
shuffle of all rows has been started.) Give it a materialised input
(``session.materialize``): each pass re-reads it.
"""

from __future__ import annotations

import math
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actuaria.session import materialize

DIGIT_BITS = 17


def _null_safe(a: list[str], b: list[str]) -> Column:
    conds = [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b)]
    return reduce(lambda p, q: p & q, conds) if conds else F.lit(True)


def exact_median(
    df: DataFrame,
    keys: list[str],
    value: str,
    precision: int = 15,
    scale: int = 2,
    alias: str = "median",
    bounds: tuple[Decimal | None, Decimal | None] | None = None,
) -> DataFrame:
    """``keys + [alias]``: the exact continuous median of DECIMAL(precision, scale)
    ``value`` per group (NULL values ignored; a group of only NULLs has no row).

    The result is DECIMAL(precision + 1, scale + 1), exact: the mean of the two
    middle values needs one more decimal place.

    ``bounds`` are the least and the greatest value where they are known already (such as
    from the write of ``df``); else one more read finds them.
    """
    if precision > 18:
        raise ValueError("exact_median needs DECIMAL precision <= 18 (unscaled values fit a long)")
    gk = [f"_g{i}" for i in range(len(keys))]
    sk = [f"_s{i}" for i in range(len(keys))]
    unscaled = (F.col(value) * F.lit(10**scale)).cast("long")
    values = df.select(*[F.col(k).alias(g) for k, g in zip(keys, gk)], unscaled.alias("_v")).where(
        F.col("_v").isNotNull()
    )
    # Digit plan from the global value range: one small aggregate (two scalars).
    if bounds is None:
        lo, hi = values.agg(F.min("_v"), F.max("_v")).first()
    else:
        lo, hi = (None if b is None else int(b.scaleb(scale)) for b in bounds)
    if lo is None:
        return df.sparkSession.createDataFrame(
            [], df.select(*keys, F.lit(None).cast(f"decimal({precision + 1},{scale + 1})").alias(alias)).schema
        )
    offset = -lo  # values shifted to [0, hi - lo]
    bits = max(1, (hi - lo).bit_length())
    passes = math.ceil(bits / DIGIT_BITS)
    digit_bits = math.ceil(bits / passes)
    mask = (1 << digit_bits) - 1
    rows = values.select(*gk, (F.col("_v") + F.lit(offset)).alias("_u"))
    in_group = Window.partitionBy(*gk)
    by_digit = in_group.orderBy("_digit")
    running = by_digit.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    state: DataFrame | None = None
    carried: list[str] = []
    for p in range(passes):
        shift = (passes - 1 - p) * digit_bits
        digit = F.shiftrightunsigned(F.col("_u"), shift).bitwiseAND(F.lit(mask)).alias("_digit")
        stats = [F.count(F.lit(1)).alias("_c"), F.min("_u").alias("_min")]
        if state is None:
            hist = rows.groupBy(*gk, digit).agg(*stats)
            hist = hist.select(
                "*",
                F.sum("_c").over(in_group).alias("_n"),
                F.lit(0).cast("long").alias("_prefix"),
            ).withColumn("_rank", F.floor((F.col("_n") - 1) / 2))
        else:
            state = materialize(state, "median-state")
            st = state.select(*[F.col(g).alias(s) for g, s in zip(gk, sk)], *state.columns[len(gk):])
            cand = rows.join(st, _null_safe(gk, sk)).where(
                F.shiftrightunsigned(F.col("_u"), shift + digit_bits) == F.col("_prefix")
            )
            hist = cand.groupBy(*gk, "_n", "_prefix", "_rank", *carried, digit).agg(*stats)
        nxt = f"_next{p}"
        hist = hist.select(
            "*",
            F.sum("_c").over(running).alias("_cum"),
            F.lead("_min").over(by_digit).alias(nxt),
        )
        state = hist.where(
            (F.col("_cum") - F.col("_c") <= F.col("_rank")) & (F.col("_rank") < F.col("_cum"))
        ).select(
            *gk,
            "_n",
            (F.shiftleft(F.col("_prefix"), digit_bits) + F.col("_digit")).alias("_prefix"),
            (F.col("_rank") - (F.col("_cum") - F.col("_c"))).alias("_rank"),
            F.col("_c").alias("_mult"),
            *carried,
            nxt,
        )
        carried.append(nxt)

    # _prefix is now the lower middle value, _mult its multiplicity.
    lower = F.col("_prefix")
    successor = F.coalesce(*[F.col(c) for c in reversed(carried)])
    upper = F.when((F.col("_n") % 2 == 1) | (F.col("_rank") + 1 < F.col("_mult")), lower).otherwise(
        successor
    )
    half_unit = F.lit(Decimal(5) / Decimal(10 ** (scale + 1)))
    total = (lower + upper - F.lit(2 * offset)).cast(f"decimal({precision + 2},0)")
    return state.select(
        *[F.col(g).alias(k) for g, k in zip(gk, keys)],
        (total * half_unit).cast(f"decimal({precision + 1},{scale + 1})").alias(alias),
    )
