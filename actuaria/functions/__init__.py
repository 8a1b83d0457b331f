from actuaria.functions.bands import (
    age_segment,
    claim_status_rule,
    high_loss_ratio_flag,
    ibnr_candidate,
    policy_status_asof,
    severity_band,
    traffic_light,
)
from actuaria.functions.formatting import millions_eur, padded_key, percent, thousands_eur, year_spine
from actuaria.functions.metrics import (
    burning_cost,
    cents_to_euros,
    combined_ratio,
    loss_ratio,
    mean,
    ratio,
    round_half_away,
    round_half_up,
    safe_divide,
    share_squared,
)

__all__ = [
    "age_segment",
    "burning_cost",
    "cents_to_euros",
    "claim_status_rule",
    "combined_ratio",
    "high_loss_ratio_flag",
    "ibnr_candidate",
    "loss_ratio",
    "mean",
    "millions_eur",
    "padded_key",
    "percent",
    "policy_status_asof",
    "ratio",
    "round_half_away",
    "round_half_up",
    "safe_divide",
    "severity_band",
    "share_squared",
    "thousands_eur",
    "traffic_light",
    "year_spine",
]
