"""Observed against expected claim frequency per (lob, region, year).

Expected claims per policy = the line's base claim frequency x the region's risk
factor. Regions without a listed factor count as 1.0 (the risk-neutral factor).
The rate tables are small fixed dimensions; the planner broadcasts them by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.functions.metrics import ratio, round_half_up

# ---- fixed values: base claim frequency per line and regional risk factors --------
BASE_FREQUENCY = {
    "auto": 0.07,
    "home": 0.04,
    "liability": 0.025,
    "health": 0.18,
}
REGION_RISK_FACTOR = {
    "Île-de-France": 1.25,
    "Auvergne-Rhône-Alpes": 1.05,
    "Provence-Alpes-Côte d'Azur": 1.10,
    "Occitanie": 0.95,
    "Nouvelle-Aquitaine": 0.90,
    "Grand Est": 1.00,
    "Hauts-de-France": 1.08,
    "Bretagne": 0.88,
}
NEUTRAL_FACTOR = 1.0
# ------------------------------------------------------------------------------------


def observed_vs_expected(mart_loss_ratio: DataFrame) -> DataFrame:
    spark = mart_loss_ratio.sparkSession
    rates = spark.createDataFrame(
        list(BASE_FREQUENCY.items()), "_r_lob string, base_frequency double"
    )
    factors = spark.createDataFrame(
        list(REGION_RISK_FACTOR.items()), "_f_region string, region_factor double"
    )
    m = mart_loss_ratio.select("line_of_business", "region", "accident_year", "policy_count", "claim_count")
    joined = m.join(rates, m.line_of_business == rates._r_lob, "left").join(
        factors, m.region == factors._f_region, "left"
    )
    expected = F.col("base_frequency") * F.coalesce(F.col("region_factor"), F.lit(NEUTRAL_FACTOR))
    return joined.select(
        "line_of_business",
        "region",
        "accident_year",
        "policy_count",
        "claim_count",
        ratio("claim_count", "policy_count", 6).alias("observed_frequency"),
        "base_frequency",
        F.coalesce(F.col("region_factor"), F.lit(NEUTRAL_FACTOR)).alias("region_factor"),
        round_half_up(expected, 6).alias("expected_frequency"),
        round_half_up(F.col("policy_count").cast("double") * expected, 2).alias("expected_claims"),
        ratio(
            F.col("claim_count").cast("double"),
            F.col("policy_count").cast("double") * expected,
            4,
        ).alias("frequency_ratio"),
    )
