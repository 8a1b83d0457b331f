"""Ceded and net losses under the reinsurance treaties.

* Excess of Loss: the reinsurer pays the part of each loss above the retention, up to
  the limit: ``least(greatest(loss - retention, 0), limit)``.
* Quota Share: the reinsurer takes a fixed share of each loss; ``retention`` holds
  the share kept, so the ceded part is ``(1 - retention) * loss``.

A claim is covered by the treaties of its LOB whose period contains the claim date.
The join key is (LOB, month), each treaty standing once in every month of its period: a
line of business is spread over its months, and the planner broadcasts the treaties
where it measures them to be small. A hot month is left to the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _treaties(stg_contracts: DataFrame) -> DataFrame:
    """One row per treaty and month of its period."""
    months = F.sequence(
        F.trunc("effective_date", "month"), F.trunc("expiry_date", "month"), F.expr("interval 1 month")
    )
    return stg_contracts.where(F.col("effective_date") <= F.col("expiry_date")).select(
        F.col("line_of_business").alias("_t_lob"),
        F.explode(months).alias("_t_month"),
        F.col("contract_id"),
        F.col("treaty_type").alias("_t_type"),
        F.col("retention").alias("_t_retention"),
        F.col("treaty_limit").alias("_t_limit"),
        F.col("effective_date").alias("_t_from"),
        F.col("expiry_date").alias("_t_to"),
    )


def ceded_losses(claims: DataFrame, stg_contracts: DataFrame) -> DataFrame:
    """One row per (claim, covering treaty); a claim no treaty covers keeps one row
    with a NULL ``contract_id`` and nothing ceded."""
    treaties = _treaties(stg_contracts)
    c = claims.select("claim_id", "line_of_business", "claim_date", "ultimate_cost_eur")
    joined = c.join(
        treaties,
        (c.line_of_business == treaties._t_lob)
        & (F.trunc(c.claim_date, "month") == treaties._t_month)
        & (c.claim_date >= treaties._t_from)
        & (c.claim_date <= treaties._t_to),
        "left",
    )
    loss = F.col("ultimate_cost_eur")
    above = F.greatest(loss - F.col("_t_retention"), F.lit(0))
    xl = F.when(F.col("_t_limit").isNull(), above).otherwise(F.least(above, F.col("_t_limit")))
    qs = (F.lit(1) - F.col("_t_retention")) * loss
    ceded = (
        F.when(F.col("_t_type") == "Excess of Loss", xl)
        .when(F.col("_t_type") == "Quota Share", qs)
        .otherwise(F.lit(0))
    )
    return joined.select(
        "claim_id",
        "line_of_business",
        F.year("claim_date").alias("accident_year"),
        "contract_id",
        F.col("_t_type").alias("treaty_type"),
        loss.cast("decimal(18,2)").alias("gross_eur"),
        ceded.cast("decimal(18,2)").alias("ceded_eur"),
    )


def ceded_by_segment(claims: DataFrame, stg_contracts: DataFrame) -> DataFrame:
    """Gross, ceded and net totals per (lob, accident year). Gross is summed over the
    claims, ceded over the (claim, treaty) rows, so a claim covered twice is not
    counted twice in gross."""
    keys = ["line_of_business", "accident_year"]
    gross = claims.groupBy("line_of_business", F.year("claim_date").alias("accident_year")).agg(
        F.count(F.lit(1)).alias("claim_count"),
        F.sum("ultimate_cost_eur").cast("decimal(18,2)").alias("gross_eur"),
    )
    ceded = (
        ceded_losses(claims, stg_contracts)
        .groupBy(*keys)
        .agg(
            F.sum("ceded_eur").cast("decimal(18,2)").alias("ceded_eur"),
            F.count("contract_id").alias("covered_claim_treaty_pairs"),
        )
    )
    out = gross.join(ceded, keys, "left")
    zero = F.lit(0).cast("decimal(18,2)")
    return out.select(
        *keys,
        "claim_count",
        "gross_eur",
        F.coalesce("ceded_eur", zero).alias("ceded_eur"),
        (F.col("gross_eur") - F.coalesce("ceded_eur", zero)).cast("decimal(18,2)").alias("net_eur"),
        F.coalesce("covered_claim_treaty_pairs", F.lit(0).cast("bigint")).alias("covered_claim_treaty_pairs"),
    )
