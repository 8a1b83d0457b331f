"""Queries behind the portfolio dashboard, over the loss-ratio mart.

The mart has one row per (lob, region, year), so everything here is small; the
functions still never collect: the default year selection is a DataFrame joined back
with a semi join, and each panel is its own aggregate. Panels follow the reference
screen: KPI cards, LOB and region charts use the *filtered* mart; the trend and the
alert table use the *unfiltered* one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.functions.bands import LINES_OF_BUSINESS, traffic_light
from actuaria.functions.formatting import millions_eur, percent, thousands_eur
from actuaria.functions.metrics import ratio

# ---- fixed values: the "all lines" option label and default selection size -------
ALL_LINES = "Toutes"
DEFAULT_YEAR_COUNT = 2
# -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class DashboardFilter:
    """Sidebar state: one LOB (or all), a set of years (empty = all), alerts only."""

    lob: str | None = None
    years: tuple[int, ...] = field(default_factory=tuple)
    alerts_only: bool = False


def default_years(mart: DataFrame, n: int = DEFAULT_YEAR_COUNT) -> DataFrame:
    """The ``n`` most recent distinct accident years (the default multi-select)."""
    return mart.select("accident_year").distinct().orderBy(F.desc("accident_year")).limit(n)


def filter_options(mart: DataFrame) -> DataFrame:
    """Options of the two selectors as rows ``(selector, value, sort_key)``: the LOB
    list is "all" followed by the sorted LOBs, the years are newest first."""
    lob_rows = (
        mart.select(F.col("line_of_business").alias("value"))
        .distinct()
        .select(
            F.lit("line_of_business").alias("selector"),
            "value",
            F.concat(F.lit("1"), F.col("value")).alias("sort_key"),
        )
    )
    all_row = mart.limit(1).select(
        F.lit("line_of_business").alias("selector"),
        F.lit(ALL_LINES).alias("value"),
        F.lit("0").alias("sort_key"),
    )
    year_rows = (
        mart.select("accident_year")
        .distinct()
        .select(
            F.lit("accident_year").alias("selector"),
            F.col("accident_year").cast("string").alias("value"),
            F.lpad((F.lit(99999) - F.col("accident_year")).cast("string"), 5, "0").alias("sort_key"),
        )
    )
    return all_row.unionByName(lob_rows).unionByName(year_rows).orderBy("selector", "sort_key")


def apply_filter(mart: DataFrame, f: DashboardFilter, years: DataFrame | None = None) -> DataFrame:
    """Equality filter on LOB ("all" bypasses), IN-list on years (empty bypasses, or a
    DataFrame of years joined as a semi join), and the high-loss-ratio flag."""
    out = mart
    if f.lob and f.lob != ALL_LINES:
        out = out.where(F.col("line_of_business") == f.lob)
    if f.years:
        out = out.where(F.col("accident_year").isin(list(f.years)))
    elif years is not None:
        out = out.join(years, "accident_year", "left_semi")
    if f.alerts_only:
        out = out.where(F.col("high_loss_ratio_flag"))
    return out


def default_view(mart: DataFrame) -> DataFrame:
    """The screen as first opened: all lines, the two latest years, no alert filter."""
    return apply_filter(mart, DashboardFilter(), default_years(mart))


def kpi_cards(filtered: DataFrame) -> DataFrame:
    """One row: premium, incurred, loss ratio (0 without premium) and its traffic
    light, claims, policies, frequency, mean severity, IBNR count and rate."""
    totals = filtered.agg(
        F.sum("earned_premium_eur").cast("decimal(18,2)").alias("total_premium_eur"),
        F.sum("incurred_losses_eur").cast("decimal(18,2)").alias("total_incurred_eur"),
        F.sum("claim_count").cast("bigint").alias("total_claims"),
        F.sum("policy_count").cast("bigint").alias("total_policies"),
        F.sum("ibnr_claims_count").cast("bigint").alias("ibnr_claims"),
    )
    zero = F.lit(0.0)
    lr = F.coalesce(ratio("total_incurred_eur", "total_premium_eur"), zero)
    return totals.select(
        "*",
        lr.alias("overall_loss_ratio"),
        F.coalesce(ratio("total_claims", "total_policies"), zero).alias("overall_frequency"),
        F.coalesce(ratio("total_incurred_eur", "total_claims"), zero).alias("avg_severity_eur"),
        F.coalesce(ratio("ibnr_claims", "total_claims"), zero).alias("ibnr_rate"),
        traffic_light(lr).alias("loss_ratio_light"),
    )


def kpi_cards_text(kpis: DataFrame) -> DataFrame:
    """The five card strings (presentation only, last projection)."""
    return kpis.select(
        percent("overall_loss_ratio", 1).alias("loss_ratio_text"),
        millions_eur("total_premium_eur", 1).alias("premium_text"),
        millions_eur("total_incurred_eur", 1).alias("incurred_text"),
        percent("overall_frequency", 2).alias("frequency_text"),
        percent("ibnr_rate", 1).alias("ibnr_rate_text"),
        "loss_ratio_light",
    )


def lob_loss_ratio(filtered: DataFrame) -> DataFrame:
    """Loss ratio per LOB, ascending (NULL when a LOB has no premium)."""
    return (
        filtered.groupBy("line_of_business")
        .agg(
            F.sum("earned_premium_eur").cast("decimal(18,2)").alias("earned"),
            F.sum("incurred_losses_eur").cast("decimal(18,2)").alias("incurred"),
        )
        .withColumn("loss_ratio", ratio("incurred", "earned"))
        .orderBy(F.asc_nulls_last("loss_ratio"))
    )


def region_frequency(filtered: DataFrame) -> DataFrame:
    """Claims per policy per region, descending."""
    return (
        filtered.groupBy("region")
        .agg(
            F.sum("claim_count").cast("bigint").alias("claims"),
            F.sum("policy_count").cast("bigint").alias("policies"),
        )
        .withColumn("freq", ratio("claims", "policies"))
        .orderBy(F.desc_nulls_last("freq"))
    )


def loss_ratio_trend(mart: DataFrame) -> DataFrame:
    """Loss ratio per (year, LOB) over the whole, unfiltered mart."""
    return (
        mart.groupBy("accident_year", "line_of_business")
        .agg(
            F.sum("earned_premium_eur").cast("decimal(18,2)").alias("ep"),
            F.sum("incurred_losses_eur").cast("decimal(18,2)").alias("il"),
        )
        .withColumn("lr", ratio("il", "ep"))
    )


ALERT_COLUMNS = [
    "line_of_business",
    "region",
    "accident_year",
    "loss_ratio",
    "earned_premium_eur",
    "claim_count",
]


def alerts(mart: DataFrame) -> DataFrame:
    """Segments flagged above the 85 % threshold, worst first (unfiltered mart)."""
    return (
        mart.where(F.col("high_loss_ratio_flag"))
        .select(*ALERT_COLUMNS)
        .orderBy(F.desc_nulls_last("loss_ratio"))
    )


def alerts_text(alerts_df: DataFrame) -> DataFrame:
    """The alert table as displayed: loss ratio as a percentage, premium in euros."""
    return alerts_df.select(
        "line_of_business",
        "region",
        "accident_year",
        percent("loss_ratio", 1).alias("loss_ratio"),
        thousands_eur("earned_premium_eur").alias("earned_premium_eur"),
        "claim_count",
    )


def actuarial_summary(raw_policies: DataFrame, raw_claims: DataFrame) -> DataFrame:
    """Per LOB on the raw layer: earned premium, incurred cost, S/P and frequency
    (0 when the denominator is 0) and the policy count, for the four lines."""
    lines = raw_policies.sparkSession.createDataFrame(
        [(i, name) for i, name in enumerate(LINES_OF_BUSINESS)], "position int, lob string"
    )
    pol = raw_policies.groupBy("lob").agg(
        F.sum("annual_premium").cast("decimal(18,2)").alias("earned"),
        F.count(F.lit(1)).alias("policies"),
    )
    clm = raw_claims.groupBy("lob").agg(
        F.sum("ultimate_cost").cast("decimal(18,2)").alias("incurred"),
        F.count(F.lit(1)).alias("claims"),
    )
    zero_money = F.lit(0).cast("decimal(18,2)")
    out = lines.join(pol, "lob", "left").join(clm, "lob", "left")
    earned = F.coalesce("earned", zero_money)
    incurred = F.coalesce("incurred", zero_money)
    policies = F.coalesce("policies", F.lit(0).cast("bigint"))
    claims = F.coalesce("claims", F.lit(0).cast("bigint"))
    return out.select(
        "position",
        "lob",
        earned.alias("earned_premium"),
        incurred.alias("incurred_cost"),
        F.coalesce(ratio(incurred, earned), F.lit(0.0)).alias("loss_ratio"),
        F.coalesce(ratio(claims, policies), F.lit(0.0)).alias("frequency"),
        policies.alias("policies"),
    ).orderBy("position")
