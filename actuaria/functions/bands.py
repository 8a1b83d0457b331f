"""Banding, flag and status rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from actuaria.functions.metrics import ColumnOrName, as_double, col_

# ---- fixed values: band labels and business thresholds -------------------------
AGE_BANDS = ("Young Driver", "26-40", "41-60", "Senior", "Unknown")
SEVERITY_BANDS = ("Small", "Medium", "Large", "Severe")
SEVERITY_LIMITS = (1000, 10000, 100000)
IBNR_LAG_DAYS = 30
HIGH_LOSS_RATIO = 0.85
GREEN_BELOW = 0.70
MARKET_TARGET = 0.75
LR_SANITY_BOUND = 5.0
LR_SANITY_MIN_PREMIUM = 10000
OVERPAYMENT_TOLERANCE = "1.05"
CLOSED_PAID_SHARE = 0.9
LINES_OF_BUSINESS = ("Auto", "Home", "Liability", "Health")
# --------------------------------------------------------------------------------


def age_segment(age: ColumnOrName) -> Column:
    """18-25 / 26-40 / 41-60 / over 60; anything else (under 18, NULL) is Unknown."""
    a = col_(age)
    young, mid, mature, senior, unknown = AGE_BANDS
    return (
        F.when(a.between(18, 25), young)
        .when(a.between(26, 40), mid)
        .when(a.between(41, 60), mature)
        .when(a > 60, senior)
        .otherwise(unknown)
    )


def severity_band(cost: ColumnOrName) -> Column:
    """Half-open bands on the ultimate cost: <1000, <10000, <100000, else Severe."""
    c = col_(cost)
    small, medium, large, severe = SEVERITY_BANDS
    lo, mid, hi = SEVERITY_LIMITS
    return F.when(c < lo, small).when(c < mid, medium).when(c < hi, large).otherwise(severe)


def ibnr_candidate(lag_days: ColumnOrName) -> Column:
    """Reported more than 30 days after occurrence; a NULL lag is False."""
    return F.coalesce(col_(lag_days) > IBNR_LAG_DAYS, F.lit(False))


def high_loss_ratio_flag(losses: ColumnOrName, premium: ColumnOrName) -> Column:
    """Unrounded losses / premium above 0.85, False when premium is not positive."""
    p = col_(premium)
    lr = F.try_divide(as_double(losses), as_double(p))
    return F.coalesce((p > 0) & (lr > HIGH_LOSS_RATIO), F.lit(False))


def traffic_light(lr: ColumnOrName) -> Column:
    """red above 0.85, green below 0.70, amber otherwise."""
    x = col_(lr)
    return F.when(x > HIGH_LOSS_RATIO, "red").when(x < GREEN_BELOW, "green").otherwise("amber")


def policy_status_asof(expiry: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Active while the expiry date lies after the reference date, else Expired."""
    return F.when(col_(expiry) > col_(as_of), "Active").otherwise("Expired")


def claim_status_rule(paid: ColumnOrName, ultimate: ColumnOrName) -> Column:
    """Closed once at least 90 % of the ultimate cost is paid, else Open."""
    return F.when(
        as_double(paid) >= F.lit(CLOSED_PAID_SHARE) * as_double(ultimate), "Closed"
    ).otherwise("Open")
