"""Staging models: clean, type and validate the raw layer.

Null-id / non-positive-premium / empty-term filters are applied to the raw columns
before any cast, so that they reach the scan when the raw layer is a parquet table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.functions.bands import OVERPAYMENT_TOLERANCE, age_segment, ibnr_candidate

POLICY_COLUMNS = (
    "policy_id line_of_business region insured_age inception_date expiry_date "
    "annual_premium_eur policy_status channel duration_years age_segment inception_year"
).split()

CLAIM_COLUMNS = (
    "claim_id policy_id line_of_business region claim_date reporting_date "
    "ultimate_cost_eur reserve_eur paid_amount_eur claim_status claim_type "
    "reporting_lag_days is_ibnr_candidate"
).split()

CONTRACT_COLUMNS = (
    "contract_id line_of_business treaty_type retention treaty_limit reinstatements "
    "premium_rate effective_date expiry_date treaty_duration_days"
).split()


def _audit(df: DataFrame, audit: bool) -> DataFrame:
    return df.withColumn("_loaded_at", F.current_timestamp()) if audit else df


def stg_policies(raw: DataFrame, audit: bool = False) -> DataFrame:
    """Typed policies; drops NULL ids, non-positive premiums and empty terms."""
    kept = raw.where(
        F.col("policy_id").isNotNull()
        & (F.col("annual_premium") > 0)
        & (F.col("inception_date") < F.col("expiry_date"))
    )
    inception = F.col("inception_date").cast("date")
    expiry = F.col("expiry_date").cast("date")
    out = kept.select(
        "policy_id",
        F.lower("lob").alias("line_of_business"),
        "region",
        "insured_age",
        inception.alias("inception_date"),
        expiry.alias("expiry_date"),
        F.col("annual_premium").cast("decimal(12,2)").alias("annual_premium_eur"),
        F.initcap("status").alias("policy_status"),
        "channel",
        (F.datediff(expiry, inception).cast("double") / F.lit(365.25)).alias("duration_years"),
        age_segment("insured_age").alias("age_segment"),
        F.year(inception).alias("inception_year"),
    )
    return _audit(out, audit)


def stg_claims(raw: DataFrame, audit: bool = False) -> DataFrame:
    """Typed claims; drops NULL keys/dates, negative amounts and overpaid claims.

    A NULL amount is dropped too (``NULL >= 0`` is not true). Overpayment tolerance:
    ``paid <= 1.05 * ultimate``, compared exactly in DECIMAL.
    """
    kept = raw.where(
        F.col("claim_id").isNotNull()
        & F.col("policy_id").isNotNull()
        & F.col("claim_date").isNotNull()
    )
    claim_date = F.col("claim_date").cast("date")
    reporting_date = F.col("reporting_date").cast("date")
    lag = F.datediff(reporting_date, claim_date)
    typed = kept.select(
        "claim_id",
        "policy_id",
        F.lower("lob").alias("line_of_business"),
        "region",
        claim_date.alias("claim_date"),
        reporting_date.alias("reporting_date"),
        F.col("ultimate_cost").cast("decimal(15,2)").alias("ultimate_cost_eur"),
        F.col("reserve").cast("decimal(15,2)").alias("reserve_eur"),
        F.col("paid_amount").cast("decimal(15,2)").alias("paid_amount_eur"),
        F.initcap("status").alias("claim_status"),
        "claim_type",
        lag.alias("reporting_lag_days"),
        ibnr_candidate(lag).alias("is_ibnr_candidate"),
    )
    tolerance = F.lit(Decimal(OVERPAYMENT_TOLERANCE))
    validated = typed.where(
        (F.col("ultimate_cost_eur") >= 0)
        & (F.col("paid_amount_eur") >= 0)
        & (F.col("paid_amount_eur") <= F.col("ultimate_cost_eur") * tolerance)
    )
    return _audit(validated, audit)


def stg_contracts(raw: DataFrame, audit: bool = False) -> DataFrame:
    """Typed treaties; date strings become DATE (unparseable ones NULL)."""
    effective = F.try_to_date(F.col("effective_date"))
    expiry = F.try_to_date(F.col("expiry_date"))
    out = raw.where(F.col("contract_id").isNotNull()).select(
        "contract_id",
        F.lower("lob").alias("line_of_business"),
        "treaty_type",
        F.col("retention").cast("decimal(15,2)").alias("retention"),
        F.col("`limit`").cast("decimal(15,2)").alias("treaty_limit"),
        "reinstatements",
        F.col("premium_rate").cast("decimal(8,6)").alias("premium_rate"),
        effective.alias("effective_date"),
        expiry.alias("expiry_date"),
        F.datediff(expiry, effective).alias("treaty_duration_days"),
    )
    return _audit(out, audit)
