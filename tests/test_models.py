"""Hand-written edge frames for the staging, intermediate and mart models."""

import datetime as dt
from decimal import Decimal as D

from actuaria.operators import intermediate, marts, staging
from actuaria.sources.rawlayer import raw_contracts
from actuaria.sources.tables import RAW_CLAIMS_SCHEMA, RAW_POLICIES_SCHEMA

DAY = dt.date(2023, 3, 1)
NEXT_YEAR = DAY + dt.timedelta(days=365)


def policies(spark, rows):
    return spark.createDataFrame(rows, RAW_POLICIES_SCHEMA)


def claims(spark, rows):
    return spark.createDataFrame(rows, RAW_CLAIMS_SCHEMA)


def pol(pid, lob="Auto", region="R1", age=30, premium="500.00", day=DAY, expiry=NEXT_YEAR, status="ACTIVE"):
    return (pid, lob, region, age, day, expiry, None if premium is None else D(premium), status, "Direct")


def clm(cid, pid, lob="Auto", region="R1", cost="100.00", paid="50.00", reserve="10.00", day=DAY,
        reported=DAY + dt.timedelta(days=5), status="open", ctype="Theft"):
    return (cid, pid, lob, region, day, reported, D(cost), None if reserve is None else D(reserve),
            None if paid is None else D(paid), status, ctype)


def test_stg_policies_drops_dirty_rows_and_types(spark):
    raw = policies(spark, [
        pol("P1"), pol(None), pol("P3", premium="0.00"), pol("P4", premium=None),
        pol("P5", expiry=DAY), pol("P6", age=17, status="expired"),
    ])
    out = {r.policy_id: r for r in staging.stg_policies(raw).collect()}
    assert set(out) == {"P1", "P6"}
    assert out["P1"].line_of_business == "auto" and out["P1"].policy_status == "Active"
    assert out["P6"].policy_status == "Expired" and out["P6"].age_segment == "Unknown"
    assert abs(out["P1"].duration_years - 365 / 365.25) < 1e-12
    assert out["P1"].inception_year == 2023


def test_stg_claims_overpayment_tolerance_and_nulls(spark):
    raw = claims(spark, [
        clm("C1", "P1", cost="100.00", paid="105.00"),   # exactly 1.05x: kept
        clm("C2", "P1", cost="100.00", paid="105.01"),   # one cent above: dropped
        clm("C3", "P1", paid="-1.00"),                    # negative paid: dropped
        clm("C4", "P1", paid=None),                       # NULL amount: dropped
        clm("C5", None),                                  # NULL policy: dropped
        clm("C6", "P1", reported=None),                   # NULL reporting date: kept, lag NULL
        clm("C7", "P1", reported=DAY + dt.timedelta(days=31)),
        clm("C8", "P1", reported=DAY + dt.timedelta(days=30)),
    ])
    out = {r.claim_id: r for r in staging.stg_claims(raw).collect()}
    assert set(out) == {"C1", "C6", "C7", "C8"}
    assert out["C6"].reporting_lag_days is None and out["C6"].is_ibnr_candidate is False
    assert out["C7"].is_ibnr_candidate is True and out["C8"].is_ibnr_candidate is False
    assert out["C1"].claim_status == "Open"


def test_loss_ratio_full_outer_join_keeps_null_region_apart(spark):
    sp = staging.stg_policies(policies(spark, [pol("P1"), pol("P2", region=None), pol("P3", region="R9")]))
    sc = staging.stg_claims(claims(spark, [
        clm("C1", "P1"), clm("C2", "P2", region=None), clm("C3", "PX", region="R7"),
    ]))
    rows = marts.loss_ratio_mart(sp, sc).collect()
    null_region = [r for r in rows if r.region is None]
    assert len(null_region) == 2  # NULL keys never match: premium row and claims row
    claims_only = [r for r in rows if r.region == "R7"][0]
    assert claims_only.policy_count == 0 and claims_only.earned_premium_eur == D("0.00")
    assert claims_only.loss_ratio is None and claims_only.high_loss_ratio_flag is False
    premium_only = [r for r in rows if r.region == "R9"][0]
    assert premium_only.claim_count == 0 and premium_only.avg_severity_eur is None
    assert sum(r.claim_count for r in rows) == 3


def test_enriched_orphan_claim_and_repaired_columns(spark):
    sp = staging.stg_policies(policies(spark, [pol("P1", premium="200.00")]))
    sc = staging.stg_claims(claims(spark, [clm("C1", "P1", cost="50.00", paid="10.00", reserve="30.00"), clm("C2", "P404")]))
    out = {r.claim_id: r for r in intermediate.claims_enriched(sc, sp).collect()}
    assert out["C2"].annual_premium_eur is None and out["C2"].loss_ratio is None
    c1 = out["C1"]
    assert c1.loss_ratio == 0.25 and c1.claim_to_premium_ratio == 0.25
    assert c1.outstanding_reserve_eur == D("20.00")
    assert c1.burning_cost_eur == D(str(round(50 / 0.999316, 2)))


def test_portfolio_treaty_fan_out_and_health_without_treaty(spark):
    sp = staging.stg_policies(policies(spark, [pol("P1", lob="Auto"), pol("P2", lob="Health")]))
    two_auto = raw_contracts(spark).unionByName(
        spark.createDataFrame([("XL-AUTO-B", "Auto", "Excess of Loss", 1.0, 2.0, 1.0, 0.01, "2023-01-01", "2023-12-31")],
                              raw_contracts(spark).schema)
    )
    rows = intermediate.portfolio(sp, staging.stg_contracts(two_auto)).collect()
    auto = [r for r in rows if r.line_of_business == "auto"]
    health = [r for r in rows if r.line_of_business == "health"]
    assert len(auto) == 2  # LOB-only join: two treaties duplicate the segment
    assert len(health) == 1 and health[0].treaty_type is None


def test_portfolio_performance_repeats_claims_on_sub_segments(spark):
    sp = staging.stg_policies(policies(spark, [pol("P1", age=30), pol("P2", age=50)]))
    sc = staging.stg_claims(claims(spark, [clm("C1", "P1")]))
    enriched = intermediate.claims_enriched(sc, sp)
    perf = marts.portfolio_performance_mart(
        intermediate.portfolio(sp, staging.stg_contracts(raw_contracts(spark))), enriched
    ).collect()
    assert len(perf) == 2
    assert sum(r.claim_count for r in perf) == 2  # one claim, repeated on both age bands
    assert abs(sum(r.premium_share for r in perf) - 1.0) < 1e-9


def test_claims_frequency_median_and_policy_count(spark):
    sp = staging.stg_policies(policies(spark, [pol("P1"), pol("P2")]))
    sc = staging.stg_claims(claims(spark, [
        clm("C1", "P1", cost="10.00", paid="0"), clm("C2", "P1", cost="20.01", paid="0"),
        clm("C3", "P2", cost="30.00", paid="0"), clm("C4", "P2", cost="1000.00", paid="0"),
    ]))
    out = marts.claims_frequency_mart(intermediate.claims_enriched(sc, sp), sp, materialize_input=False).collect()
    assert len(out) == 1
    r = out[0]
    assert r.median_severity_eur == D("25.005") and r.claim_count == 4 and r.policy_count == 2
    assert r.small_claims == 3 and r.medium_claims == 1 and r.observed_frequency == 2.0


def test_ceded_losses_excess_of_loss_and_quota_share(spark):
    from actuaria.operators.reinsurance import ceded_by_segment, ceded_losses

    day = dt.date(1997, 6, 1)
    raw = claims(spark, [
        clm("A1", "P", lob="Auto", cost="50000.00", paid="0", day=day, reported=day),    # below retention
        clm("A2", "P", lob="Auto", cost="300000.00", paid="0", day=day, reported=day),   # 200k ceded
        clm("A3", "P", lob="Auto", cost="900000.00", paid="0", day=day, reported=day),   # capped at 500k
        clm("L1", "P", lob="Liability", cost="1000.00", paid="0", day=day, reported=day),  # 30 % ceded
        clm("H1", "P", lob="Health", cost="1000.00", paid="0", day=day, reported=day),   # no treaty
        clm("A4", "P", lob="Auto", cost="300000.00", paid="0", reported=dt.date(2003, 6, 1), day=dt.date(2003, 6, 1)),  # outside the period
    ])
    sc = staging.stg_claims(raw)
    contracts = staging.stg_contracts(raw_contracts(spark))
    got = {r.claim_id: r.ceded_eur for r in ceded_losses(sc, contracts).collect()}
    assert got == {"A1": D("0.00"), "A2": D("200000.00"), "A3": D("500000.00"), "L1": D("300.00"),
                   "H1": D("0.00"), "A4": D("0.00")}
    seg = {(r.line_of_business, r.accident_year): r for r in ceded_by_segment(sc, contracts).collect()}
    auto = seg[("auto", 1997)]
    assert auto.gross_eur == D("1250000.00") and auto.ceded_eur == D("700000.00") and auto.net_eur == D("550000.00")
    assert auto.covered_claim_treaty_pairs == 3 and seg[("auto", 2003)].ceded_eur == D("0.00")


def test_two_earned_premium_measures_are_not_unified(spark):
    """The mart sums premium over all policies; the summary sums it once per claim,
    over policies with claims only (SURVEY §1.4 item 7)."""
    sp = staging.stg_policies(policies(spark, [pol("P1", premium="100.00"), pol("P2", premium="50.00")]))
    sc = staging.stg_claims(claims(spark, [clm("C1", "P1"), clm("C2", "P1")]))
    mart = marts.loss_ratio_mart(sp, sc).collect()
    summary = intermediate.portfolio_summary(intermediate.claims_enriched(sc, sp), sc).collect()
    assert [r.earned_premium_eur for r in mart] == [D("150.00")]
    assert [r.earned_premium_eur for r in summary] == [D("200.00")]
    assert summary[0].policy_count == 1 and mart[0].policy_count == 2


def test_observed_vs_expected_frequency(spark):
    from actuaria.operators.experience import observed_vs_expected

    mart = spark.createDataFrame(
        [("auto", "Île-de-France", 2020, 100, 14), ("health", "AFRICA", 2020, 50, 9), ("home", "R", 2020, 0, 1)],
        "line_of_business string, region string, accident_year int, policy_count bigint, claim_count bigint",
    )
    rows = {r.region: r for r in observed_vs_expected(mart).collect()}
    idf = rows["Île-de-France"]
    assert idf.region_factor == 1.25 and idf.expected_frequency == 0.0875 and idf.expected_claims == 8.75
    assert idf.frequency_ratio == 1.6 and idf.observed_frequency == 0.14
    assert rows["AFRICA"].region_factor == 1.0 and rows["AFRICA"].frequency_ratio == 1.0
    assert rows["R"].observed_frequency is None and rows["R"].frequency_ratio is None


def test_staged_column_lists(spark):
    sp = staging.stg_policies(policies(spark, [pol("P1")]))
    sc = staging.stg_claims(claims(spark, [clm("C1", "P1")]))
    assert sp.columns == staging.POLICY_COLUMNS and sc.columns == staging.CLAIM_COLUMNS
    assert staging.stg_contracts(raw_contracts(spark)).columns == staging.CONTRACT_COLUMNS
    assert intermediate.claims_enriched(sc, sp).columns == intermediate.ENRICHED_COLUMNS
    assert staging.stg_claims(raw_claims_audit := claims(spark, [clm("C2", "P1")]), audit=True).columns[-1] == "_loaded_at"
    assert raw_claims_audit.count() == 1


def test_claims_frequency_approximate_median_option(spark):
    sp = staging.stg_policies(policies(spark, [pol("P1"), pol("P2")]))
    sc = staging.stg_claims(claims(spark, [
        clm("C1", "P1", cost="10.00", paid="0"), clm("C2", "P1", cost="20.00", paid="0"),
        clm("C3", "P2", cost="30.00", paid="0"),
    ]))
    enriched = intermediate.claims_enriched(sc, sp)
    exact = marts.claims_frequency_mart(enriched, sp, materialize_input=False).first()
    approx = marts.claims_frequency_mart(enriched, sp, median="approx").first()
    assert exact.median_severity_eur == D("20.000") and approx.median_severity_eur == D("20.000")
    assert approx.claim_count == exact.claim_count == 3


def test_portfolio_summary_approximate_distinct_option(spark):
    sp = staging.stg_policies(policies(spark, [pol(f"P{i}") for i in range(50)]))
    sc = staging.stg_claims(claims(spark, [clm(f"C{i}", f"P{i % 50}") for i in range(200)]))
    enriched = intermediate.claims_enriched(sc, sp)
    exact = intermediate.portfolio_summary(enriched, sc).first()
    approx = intermediate.portfolio_summary(enriched, sc, approx_distinct_rsd=0.01).first()
    assert exact.policy_count == 50 and abs(approx.policy_count - 50) <= 2
