"""Mergeable segment states: one pass over policies or claims, from which the marts roll up.

A state is an aggregate at the finest grain that any mart asks for, in measures that can be
merged: sums, counts, least and greatest values (a mean is its sum and its count). Sums keep
their full precision; a mart casts what it shows. Rolling a state up gives the same rows as the
aggregate over all policies or claims, from a few thousand rows.

Distinct counts do not add up. Their state is the set itself, as bitmaps over dense policy
numbers (:func:`policy_bitmaps`): merged by OR, counted exactly at any coarser grain.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.session import materialize

POLICY_KEYS = ["line_of_business", "region", "inception_year", "channel", "age_segment"]
CLAIM_KEYS = ["line_of_business", "region", "age_segment", "accident_year", "claim_type"]


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _policy_measures() -> dict[str, Column]:
    premium, status = F.col("annual_premium_eur"), F.col("policy_status")
    return {
        "policy_count": F.count("policy_id"),
        "premium_sum": F.sum(premium),
        "premium_n": F.count(premium),
        "premium_min": F.min(premium),
        "premium_max": F.max(premium),
        "age_sum": F.sum("insured_age"),
        "age_n": F.count("insured_age"),
        "active_policies": _count_if(status == "Active"),
        "expired_policies": _count_if(status == "Expired"),
    }


def _claim_measures() -> dict[str, Column]:
    cost, band = F.col("ultimate_cost_eur"), F.col("severity_band")
    return {
        "claim_count": F.count("claim_id"),
        "cost_sum": F.sum(cost),
        "cost_n": F.count(cost),
        "cost_max": F.max(cost),
        "paid_sum": F.sum("paid_amount_eur"),
        "reserve_sum": F.sum("reserve_eur"),
        "outstanding_sum": F.sum("outstanding_reserve_eur"),
        "claim_premium_sum": F.sum("annual_premium_eur"),
        "burning_cost_sum": F.sum("burning_cost_eur"),
        "burning_cost_n": F.count("burning_cost_eur"),
        "lag_sum": F.sum("reporting_lag_days"),
        "lag_n": F.count("reporting_lag_days"),
        "ibnr_count": _count_if(F.col("is_ibnr_candidate")),
        "open_count": _count_if(F.col("claim_status") == "Open"),
        "small_claims": _count_if(band == "Small"),
        "medium_claims": _count_if(band == "Medium"),
        "large_claims": _count_if(band == "Large"),
        "severe_claims": _count_if(band == "Severe"),
    }


def policies_state(stg_policies: DataFrame) -> DataFrame:
    """Measures of the staged policies per :data:`POLICY_KEYS`."""
    return stg_policies.groupBy(*POLICY_KEYS).agg(*(m.alias(n) for n, m in _policy_measures().items()))


def claims_state(enriched: DataFrame) -> DataFrame:
    """Measures of the enriched claims per :data:`CLAIM_KEYS`."""
    return measures_of(enriched, CLAIM_KEYS)


def measures_of(enriched: DataFrame, keys: list[str], measures: list[str] | None = None) -> DataFrame:
    """The claims' measures (all, or those named) at a grain of one's own."""
    every = _claim_measures()
    return enriched.groupBy(*keys).agg(*(every[n].alias(n) for n in measures or every))


def rolled_up(state: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """The state at a coarser grain: every measure merged by its kind; ``more`` aggregates beside them."""
    merge = {"min": F.min, "max": F.max}
    known = (*_policy_measures(), *_claim_measures())
    measures = [c for c in state.columns if c in known]
    merged = (merge.get(c.rsplit("_", 1)[-1], F.sum)(c).alias(c) for c in measures)
    return state.groupBy(*keys).agg(*merged, *more)


SEEN_KEYS = ["line_of_business", "region", "accident_year"]


def policy_bitmaps(stg_claims: DataFrame) -> DataFrame:
    """The policies with claims per :data:`SEEN_KEYS`: bitmaps of 32,768 policy numbers each.

    Policies are numbered densely in the order of their first segment, so the policies of a
    segment lie close together and few bitmaps are sparse. The numbers come from a range sort,
    each task numbering its own range; the ranges' sizes (one number for each task) give the
    offsets. A policy's claims are reduced to its few segments before any sort, and a segment is spread
    over the tasks by bitmap, so neither a hot policy nor a hot segment meets in one task.
    Claims without a policy id are in no bitmap.
    """
    segment = F.struct("line_of_business", "region", F.year("claim_date").alias("accident_year"))
    seen = stg_claims.where(F.col("policy_id").isNotNull()).groupBy("policy_id").agg(F.collect_set(segment).alias("segments"))
    order = [F.array_min("segments").alias("first"), "policy_id"]
    ranged = seen.select("segments", *order).repartitionByRange("first", "policy_id").sortWithinPartitions("first", "policy_id")
    # the row's id: the number of its range in the upper bits, its place there in the lower 33
    placed = materialize(ranged.select("segments", F.monotonically_increasing_id().alias("id")), "policies-seen")
    part = F.shiftright("id", 33).alias("part")
    sizes = placed.groupBy(part).agg(F.min("id").alias("least"), F.count("*").alias("n")).orderBy("part").collect()
    before = [0, *accumulate(r["n"] for r in sizes)]
    shifts = [(r["part"], at + 1 - r["least"]) for r, at in zip(sizes, before)]
    shift = stg_claims.sparkSession.createDataFrame(shifts, "part long, shift long")
    numbered = placed.select("segments", "id", part).join(F.broadcast(shift), "part").select(  # a row for each range
        F.explode("segments").alias("s"), (F.col("id") + F.col("shift")).alias("number")
    )
    bits = numbered.select(
        "s.*", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("position")
    )
    # built after the shuffle: a partial bitmap of every task would be far larger than its numbers
    return bits.repartition(*SEEN_KEYS, "bucket").groupBy(*SEEN_KEYS, "bucket").agg(
        F.bitmap_construct_agg("position").alias("policies")
    )


def distinct_policies(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Exact ``policy_count`` at a grain coarser than (or equal to) that of the bitmaps."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("policies").alias("policies"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("policies")).cast("bigint").alias("policy_count"))
