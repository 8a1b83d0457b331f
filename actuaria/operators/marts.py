"""Mart models: loss ratio, claims frequency/severity, portfolio performance.

Every mart aggregates both sides *before* joining them, so the joins run on a few
thousand segment rows, not on claims or policies. Aggregations are partial (map-side)
+ final, so a hot segment costs no more than a cold one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from actuaria.functions.bands import high_loss_ratio_flag
from actuaria.functions.metrics import mean, ratio, share_squared
from actuaria.operators import segments
from actuaria.operators.median import exact_median
from actuaria.session import materialize

SEGMENT = ["line_of_business", "region", "accident_year"]



def loss_ratio_order() -> list[F.Column]:
    return [F.desc("accident_year"), F.desc_nulls_last("loss_ratio")]


def frequency_order() -> list[F.Column]:
    return [F.desc("accident_year"), F.desc_nulls_last("observed_frequency")]


def performance_order() -> list[F.Column]:
    return [F.desc("total_premium_eur")]


def _money(c) -> F.Column:
    return F.sum(c).cast("decimal(18,2)")


def loss_ratio_mart(stg_policies: DataFrame, stg_claims: DataFrame) -> DataFrame:
    """Loss ratio per (lob, region, year): premium by *inception* year FULL OUTER JOIN
    claims by *claim* year, zero-filled. NULL keys never match, so a NULL-region
    segment stays as two rows."""
    earned = stg_policies.groupBy(
        "line_of_business", "region", F.col("inception_year").alias("accident_year")
    ).agg(
        F.count("policy_id").alias("policy_count"),
        _money("annual_premium_eur").alias("earned_premium_eur"),
    )
    incurred = stg_claims.groupBy(
        "line_of_business", "region", F.year("claim_date").alias("accident_year")
    ).agg(
        F.count("claim_id").alias("claim_count"),
        _money("ultimate_cost_eur").alias("incurred_losses_eur"),
        _money("paid_amount_eur").alias("paid_losses_eur"),
        _money("reserve_eur").alias("total_reserve_eur"),
        F.count(F.when(F.col("is_ibnr_candidate"), 1)).alias("ibnr_claims_count"),
    )
    return _loss_ratio(earned, incurred)


def loss_ratio_of(policies: DataFrame, claims: DataFrame) -> DataFrame:
    """The same mart from the segment states. ``claims`` must be the state of enriched claims
    with one row per staged claim (no policy id held by two policies)."""
    policies = policies.withColumnRenamed("inception_year", "accident_year")
    earned = segments.rolled_up(policies, SEGMENT).select(
        *SEGMENT, "policy_count", F.col("premium_sum").cast("decimal(18,2)").alias("earned_premium_eur")
    )
    incurred = segments.rolled_up(claims, SEGMENT).select(
        *SEGMENT,
        "claim_count",
        F.col("cost_sum").cast("decimal(18,2)").alias("incurred_losses_eur"),
        F.col("paid_sum").cast("decimal(18,2)").alias("paid_losses_eur"),
        F.col("reserve_sum").cast("decimal(18,2)").alias("total_reserve_eur"),
        F.col("ibnr_count").alias("ibnr_claims_count"),
    )
    return _loss_ratio(earned, incurred)


def _loss_ratio(earned: DataFrame, incurred: DataFrame) -> DataFrame:
    zero_money = F.lit(0).cast("decimal(18,2)")
    combined = earned.join(incurred, on=SEGMENT, how="full_outer").select(
        *SEGMENT,
        F.coalesce("policy_count", F.lit(0).cast("bigint")).alias("policy_count"),
        F.coalesce("earned_premium_eur", zero_money).alias("earned_premium_eur"),
        F.coalesce("claim_count", F.lit(0).cast("bigint")).alias("claim_count"),
        F.coalesce("incurred_losses_eur", zero_money).alias("incurred_losses_eur"),
        F.coalesce("paid_losses_eur", zero_money).alias("paid_losses_eur"),
        F.coalesce("total_reserve_eur", zero_money).alias("total_reserve_eur"),
        F.coalesce("ibnr_claims_count", F.lit(0).cast("bigint")).alias("ibnr_claims_count"),
    )
    prem, inc, n = F.col("earned_premium_eur"), F.col("incurred_losses_eur"), F.col("claim_count")
    return combined.select(
        "*",
        ratio(inc, prem, 4).alias("loss_ratio"),
        ratio("paid_losses_eur", prem, 4).alias("paid_loss_ratio"),
        ratio(n, "policy_count", 4).alias("claims_frequency"),
        ratio(inc, n, 2).alias("avg_severity_eur"),
        ratio("ibnr_claims_count", n, 4).alias("ibnr_rate"),
        high_loss_ratio_flag(inc, prem).alias("high_loss_ratio_flag"),
    )


FREQUENCY_KEYS = segments.CLAIM_KEYS
FREQUENCY_MEASURES = [
    "claim_count", "cost_sum", "cost_n", "cost_max", "lag_sum", "lag_n", "ibnr_count", "small_claims",
    "medium_claims", "large_claims", "severe_claims",
]


def claims_frequency_mart(
    enriched: DataFrame,
    stg_policies: DataFrame,
    materialize_input: bool = True,
    median: str = "exact",
    approx_accuracy: int = 10_000,
    cost_bounds: tuple | None = None,
    claims: DataFrame | None = None,
    policies: DataFrame | None = None,
) -> DataFrame:
    """Frequency and severity per (lob, region, age segment, year, claim type).

    ``policy_count`` comes from policies by *inception* year and has no claim type, so
    it repeats across claim types. The median is exact and skew-safe
    (:func:`exact_median`), DECIMAL(16,3) — cast to DECIMAL(18,3).

    The claims are read three times (the aggregates and two median passes), so the
    narrow projection they need is written once to the checkpoint folder first,
    unless ``enriched`` is already a stored table (``materialize_input=False``). The range of
    the costs, which the median needs, is observed by that write, or given (``cost_bounds``).

    ``claims`` and ``policies`` are the stored segment states where there are any: the
    enriched claims are then read for the median alone.

    ``median="approx"`` is the opt-in one-pass alternative: ``percentile_approx`` keeps
    a bounded, mergeable sketch per group (relative rank error about
    ``1 / approx_accuracy``), so it is skew-safe too; it returns an observed value,
    not the interpolated mean of the two middle ones.
    """
    if median not in ("exact", "approx"):
        raise ValueError("median must be 'exact' or 'approx'")
    needed = [*FREQUENCY_KEYS, "claim_id", "ultimate_cost_eur", "reporting_lag_days",
              "is_ibnr_candidate", "severity_band"]
    enriched = enriched.select(*needed)
    if materialize_input and median == "exact":
        seen = Observation()
        cost_range = F.min("ultimate_cost_eur").alias("least"), F.max("ultimate_cost_eur").alias("most")
        enriched = materialize(enriched.observe(seen, *cost_range), "claims-frequency-input")
        cost_bounds = seen.get["least"], seen.get["most"]
    agg = segments.measures_of(enriched, FREQUENCY_KEYS, FREQUENCY_MEASURES) if claims is None else claims
    if median == "exact":
        med = exact_median(enriched, FREQUENCY_KEYS, "ultimate_cost_eur", 15, 2, "_median", cost_bounds)
    else:
        med = enriched.groupBy(*FREQUENCY_KEYS).agg(
            F.percentile_approx("ultimate_cost_eur", 0.5, approx_accuracy)
            .cast("decimal(16,3)")
            .alias("_median")
        )
    med = med.select(*[F.col(k).alias(f"_m_{k}") for k in FREQUENCY_KEYS], "_median")
    of_age = ["line_of_business", "region", "age_segment", "inception_year"]
    if policies is None:
        counted = stg_policies.groupBy(*of_age).agg(F.count("policy_id").alias("policy_count"))
    else:
        counted = segments.rolled_up(policies.select(*of_age, "policy_count"), of_age)
    names = dict(zip(of_age, ("_p_lob", "_p_region", "_p_age", "_p_year")))
    policies = counted.withColumnsRenamed(names)

    with_median = agg.join(
        med,
        [agg[k].eqNullSafe(med[f"_m_{k}"]) for k in FREQUENCY_KEYS],
        "left",
    )
    joined = with_median.join(
        policies,
        (F.col("line_of_business") == F.col("_p_lob"))
        & (F.col("region") == F.col("_p_region"))
        & (F.col("age_segment") == F.col("_p_age"))
        & (F.col("accident_year") == F.col("_p_year")),
        "left",
    )
    return joined.select(
        *FREQUENCY_KEYS,
        "claim_count",
        F.col("cost_sum").cast("decimal(18,2)").alias("total_incurred_eur"),
        mean("cost_sum", "cost_n").alias("avg_severity_eur"),
        F.col("_median").cast("decimal(18,3)").alias("median_severity_eur"),
        F.col("cost_max").alias("max_severity_eur"),
        mean("lag_sum", "lag_n").alias("avg_reporting_lag"),
        "ibnr_count",
        "small_claims",
        "medium_claims",
        "large_claims",
        "severe_claims",
        "policy_count",
        ratio("claim_count", "policy_count", 6).alias("observed_frequency"),
    )


def portfolio_performance_mart(
    portfolio: DataFrame, enriched: DataFrame, claims: DataFrame | None = None
) -> DataFrame:
    """Segments with their (lob, region, year) claims and premium concentration.

    Claims are aggregated at (lob, region, year) and joined to segments that also
    split by channel and age band, so each claims total REPEATS on every sub-segment:
    ``claim_count``, ``incurred_eur`` and ``loss_ratio`` must not be summed across
    rows. The grand total premium is a scalar subquery (one value, computed once).
    ``claims`` is the stored segment state of the claims where there is one.
    """
    sums = {"claim_count": "_claim_count", "cost_sum": "_incurred", "paid_sum": "_paid", "reserve_sum": "_reserve"}
    if claims is None:
        rolled = segments.measures_of(enriched, SEGMENT, list(sums))
    else:
        rolled = segments.rolled_up(claims.select(*segments.CLAIM_KEYS, *sums), SEGMENT)
    claims = rolled.select(
        F.col("line_of_business").alias("_c_lob"),
        F.col("region").alias("_c_region"),
        F.col("accident_year").alias("_c_year"),
        F.col("claim_count").alias("_claim_count"),
        *(F.col(c).cast("decimal(18,2)").alias(name) for c, name in sums.items() if c != "claim_count"),
    )
    grand_total = portfolio.select(F.sum("total_premium_eur")).scalar()
    joined = portfolio.join(
        claims,
        (F.col("line_of_business") == F.col("_c_lob"))
        & (F.col("region") == F.col("_c_region"))
        & (F.col("inception_year") == F.col("_c_year")),
        "left",
    )
    joined = joined.withColumn("_grand_total", grand_total)  # evaluated once
    grand_total = F.col("_grand_total")
    zero = F.lit(0).cast("decimal(18,2)")
    incurred = F.coalesce(F.col("_incurred"), zero)
    premium = F.col("total_premium_eur")
    return joined.select(
        "line_of_business",
        "region",
        "inception_year",
        "channel",
        "age_segment",
        "policy_count",
        "total_premium_eur",
        "avg_premium_eur",
        "active_policies",
        "expired_policies",
        "avg_insured_age",
        F.col("treaty_type").alias("reinsurance_type"),
        "reinsurance_retention",
        "reinsurance_limit",
        F.coalesce(F.col("_claim_count"), F.lit(0).cast("bigint")).alias("claim_count"),
        incurred.alias("incurred_eur"),
        F.coalesce(F.col("_paid"), zero).alias("paid_eur"),
        F.coalesce(F.col("_reserve"), zero).alias("reserve_eur"),
        ratio(incurred, premium, 4).alias("loss_ratio"),
        ratio(premium, grand_total, 6).alias("premium_share"),
        share_squared(premium, grand_total).alias("herfindahl_component"),
    )


__all__ = [
    "frequency_order",
    "loss_ratio_order",
    "performance_order",
    "claims_frequency_mart",
    "loss_ratio_mart",
    "portfolio_performance_mart",
]
