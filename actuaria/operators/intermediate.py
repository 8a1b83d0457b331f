"""Intermediate models: claims enriched with their policy, portfolio segments, and the
per-segment claims summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actuaria.functions.bands import high_loss_ratio_flag, severity_band
from actuaria.functions.metrics import (
    burning_cost,
    loss_ratio,
    mean,
    ratio,
    round_half_up,
    share_squared,
)
from actuaria.operators import segments

ENRICHED_COLUMNS = (
    "claim_id policy_id line_of_business region claim_date reporting_date "
    "ultimate_cost_eur reserve_eur paid_amount_eur claim_status claim_type "
    "reporting_lag_days is_ibnr_candidate annual_premium_eur policy_status channel "
    "age_segment inception_year insured_age accident_year accident_month severity_band "
    "claim_to_premium_ratio burning_cost_eur outstanding_reserve_eur loss_ratio"
).split()


def claims_enriched(stg_claims: DataFrame, stg_policies: DataFrame) -> DataFrame:
    """Each staged claim with its policy's attributes (LEFT join: orphans keep NULLs).

    This is the one large-large join of the pipeline: a sort-merge join on
    ``policy_id``; AQE splits a skewed claims partition (a policy with very many
    claims) and replicates the matching policy partition.

    Three columns downstream models and tests need are added here:
    ``burning_cost_eur`` (cost per policy-year), ``outstanding_reserve_eur``
    (reserve not yet paid, floored at 0) and ``loss_ratio`` (cost over premium).
    """
    c = stg_claims.alias("c")
    p = stg_policies.select(
        "policy_id",
        "annual_premium_eur",
        "policy_status",
        "channel",
        "age_segment",
        "inception_year",
        "insured_age",
        "duration_years",
    ).alias("p")
    joined = c.join(p, F.col("c.policy_id") == F.col("p.policy_id"), "left")
    cost = F.col("c.ultimate_cost_eur")
    premium = F.col("p.annual_premium_eur")
    return joined.select(
        *[F.col(f"c.{name}") for name in ENRICHED_COLUMNS[:13]],
        premium.alias("annual_premium_eur"),
        "p.policy_status",
        "p.channel",
        "p.age_segment",
        "p.inception_year",
        "p.insured_age",
        F.year("c.claim_date").alias("accident_year"),
        F.month("c.claim_date").alias("accident_month"),
        severity_band(cost).alias("severity_band"),
        ratio(cost, premium, when=premium != 0).alias("claim_to_premium_ratio"),
        burning_cost(cost, F.col("p.duration_years")).alias("burning_cost_eur"),
        F.greatest(F.col("c.reserve_eur") - F.col("c.paid_amount_eur"), F.lit(0))
        .cast("decimal(15,2)")
        .alias("outstanding_reserve_eur"),
        loss_ratio(cost, premium).alias("loss_ratio"),
    )


def portfolio(stg_policies: DataFrame, stg_contracts: DataFrame) -> DataFrame:
    """Policies per (lob, region, inception year, channel, age segment) + the LOB treaty."""
    return portfolio_of(segments.policies_state(stg_policies), stg_contracts)


def portfolio_of(state: DataFrame, stg_contracts: DataFrame) -> DataFrame:
    """The portfolio from the policies' segment state.

    The treaty join has no date predicate (LOB equality only); Health has no treaty,
    so its treaty columns are NULL. The treaty table is a small dimension the planner
    broadcasts from its size.
    """
    treaties = stg_contracts.select(
        F.col("line_of_business").alias("_treaty_lob"),
        "treaty_type",
        F.col("retention").alias("reinsurance_retention"),
        F.col("treaty_limit").alias("reinsurance_limit"),
        F.col("premium_rate").alias("reinsurance_rate"),
    )
    return state.join(treaties, state.line_of_business == treaties._treaty_lob, "left").select(
        *segments.POLICY_KEYS,
        "policy_count",
        F.col("premium_sum").cast("decimal(18,2)").alias("total_premium_eur"),
        mean("premium_sum", "premium_n").alias("avg_premium_eur"),
        F.col("premium_min").alias("min_premium_eur"),
        F.col("premium_max").alias("max_premium_eur"),
        mean("age_sum", "age_n").alias("avg_insured_age"),
        "active_policies",
        "expired_policies",
        "treaty_type",
        "reinsurance_retention",
        "reinsurance_limit",
        "reinsurance_rate",
    )


SUMMARY_KEYS = ["line_of_business", "region", "accident_year"]


def portfolio_summary(
    enriched: DataFrame,
    stg_claims: DataFrame,
    approx_distinct_rsd: float | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Claims KPIs per (lob, region, accident year), with the Herfindahl contribution
    of the region within its (lob, year).

    ``earned_premium_eur`` here sums the policy premium once per claim, over policies
    that had claims: it is not the mart's earned premium.

    ``policy_count`` is an exact distinct count. The measures are aggregated per (segment, policy)
    first and the segments above that, so claims and policies are joined once and the
    distinct policies are the rows of the first aggregate; it follows the join on the policy
    without a shuffle of its own. Only claims-side columns decide the segment and the policy, so
    orphans and repeated policies count as in the staged claims.
    ``state`` (the stored segment state of ``enriched``) gives the measures instead;
    only the distinct policies then read the staged claims, without a join.
    ``approx_distinct_rsd`` opts into a HyperLogLog++ count with that relative standard
    deviation (one pass, fixed-size state per segment).
    """
    keys = SUMMARY_KEYS
    own_keys = ["_p_lob", "_p_region", "_p_year"]
    if state is None and approx_distinct_rsd is None:
        measures = segments.measures_of(enriched, [*keys, "policy_id"])
        seg = segments.rolled_up(measures, keys, F.count("policy_id").alias("policy_count"))
    else:
        seg = segments.rolled_up(segments.claims_state(enriched) if state is None else state, keys)
        own = stg_claims.select(
            F.col("line_of_business").alias("_p_lob"), F.col("region").alias("_p_region"),
            F.year("claim_date").alias("_p_year"), "policy_id",
        )
        if approx_distinct_rsd is None:
            policies = own.distinct().groupBy(*own_keys).agg(F.count("policy_id").alias("policy_count"))
        else:
            policies = own.groupBy(*own_keys).agg(
                F.approx_count_distinct("policy_id", approx_distinct_rsd).alias("policy_count")
            )
        same = reduce(lambda p, q: p & q, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own_keys)])
        seg = seg.join(policies, same, "left")  # both sides are aggregates of a few thousand segments

    money = {
        "earned_premium_eur": "claim_premium_sum", "incurred_losses_eur": "cost_sum", "paid_losses_eur": "paid_sum",
        "total_reserve_eur": "reserve_sum", "outstanding_reserve_eur": "outstanding_sum",
    }
    of_line = Window.partitionBy("line_of_business", "accident_year")
    known = F.col("line_of_business").isNotNull() & F.col("accident_year").isNotNull()
    joined = seg.select(
        "*",
        F.col("open_count").alias("open_claim_count"),
        F.col("ibnr_count").alias("ibnr_candidate_count"),
        *(F.col(c).cast("decimal(18,2)").alias(name) for name, c in money.items()),
        F.when(known, F.sum("claim_count").over(of_line)).alias("lob_total_claims"),
    )
    earned, incurred = F.col("earned_premium_eur"), F.col("incurred_losses_eur")
    claims = F.col("claim_count")
    return joined.select(
        *keys,
        F.col("policy_count").cast("bigint").alias("policy_count"),
        "claim_count",
        "open_claim_count",
        "ibnr_candidate_count",
        *money,
        mean("burning_cost_sum", "burning_cost_n").alias("avg_burning_cost_eur"),
        F.col("burning_cost_sum").cast("decimal(18,2)").alias("total_burning_cost_eur"),
        ratio(incurred, earned, 4).alias("portfolio_loss_ratio"),
        ratio("paid_losses_eur", earned, 4).alias("paid_loss_ratio"),
        ratio(claims, "policy_count", 4).alias("claims_frequency"),
        ratio(incurred, claims, 2).alias("avg_severity_eur"),
        ratio("ibnr_candidate_count", claims, 4).alias("ibnr_rate"),
        ratio("total_reserve_eur", incurred, 4).alias("reserve_adequacy_ratio"),
        high_loss_ratio_flag(incurred, earned).alias("high_loss_ratio_flag"),
        round_half_up(share_squared(claims, "lob_total_claims"), 4).alias(
            "herfindahl_contribution"
        ),
    )


def summary_order() -> list[F.Column]:
    return [F.desc("accident_year"), F.desc_nulls_last("portfolio_loss_ratio")]
