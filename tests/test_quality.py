"""Each quality check must pass on clean rows and fail on seeded bad ones."""

import datetime as dt
import json
from decimal import Decimal as D

from actuaria.operators import quality
from actuaria.sources.tables import RAW_CLAIMS_SCHEMA

DAY = dt.date(2023, 1, 10)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_CLAIMS_SCHEMA)


def row(cid, lob="Auto", status="Open", cost="10.00", paid="1.00", reserve="1.00", reported=DAY):
    return (cid, "P1", lob, "R", DAY, reported, D(cost), D(reserve), D(paid), status, "Theft")


def results(spark, rows):
    tables = {"raw_claims": raw(spark, rows)}
    checks = quality.run_row_checks(tables, quality.claims_suite_checks())
    uniq = quality.run_unique_checks(tables, quality.claims_suite_unique_spec())
    return {(r.column_name, r.expectation): r for r in checks.unionByName(uniq).collect()}


def test_claims_suite_passes_on_clean_rows(spark):
    res = results(spark, [row("C1"), row("C2", status="Closed", lob="Home")])
    assert all(r.success for r in res.values())
    assert len(res) == 9


def test_claims_suite_fails_on_seeded_bad_rows(spark):
    res = results(spark, [
        row("C1"), row("C1"),                      # duplicate claim_id
        row(None),                                 # null id
        row("C3", lob="Boat"),                     # bad LOB
        row("C4", status="CLOSED"),                # bad status
        row("C5", cost="0.00"),                    # strict min
        row("C6", paid="-1.00"),                   # negative paid
        row("C7", reserve="-0.01"),                # negative reserve
        row("C8", reported=DAY - dt.timedelta(days=1)),  # reported before occurrence
    ])
    assert res[("claim_id", "unique")].unexpected == 2
    assert res[("claim_id", "not_null")].unexpected == 1
    assert res[("lob", "accepted_values")].unexpected == 1
    assert res[("status", "accepted_values")].unexpected == 1
    assert res[("ultimate_cost", "between")].unexpected == 1
    assert res[("paid_amount", "between")].unexpected == 1
    assert res[("reserve", "between")].unexpected == 1
    assert res[("reporting_date,claim_date", "a_greater_than_b")].unexpected == 1
    assert not any(r.success for r in res.values() if r.expectation != "not_null" or r.column_name == "claim_id")


def test_singular_tests_fail_branches(spark):
    mart = spark.createDataFrame(
        [("auto", "R", 2020, D("20000.00"), 6.0, 3), ("home", "R", 2020, D("-1.00"), None, 1), ("auto", "S", 2020, D("100.00"), 9.0, 0)],
        "line_of_business string, region string, accident_year int, earned_premium_eur decimal(18,2), loss_ratio double, claim_count bigint",
    )
    assert [r.region for r in quality.loss_ratio_within_bounds(mart).collect()] == ["R"]
    assert [r.line_of_business for r in quality.no_negative_premium(mart).collect()] == ["home"]
    stg = spark.range(5).withColumnRenamed("id", "claim_id")
    mismatch = quality.claim_count_consistency(mart, stg).collect()
    assert mismatch and mismatch[0].mart_claims == 4 and mismatch[0].staging_claims == 5
    enriched = spark.createDataFrame(
        [("C1", "P1", "auto", "R", 2020, D("1.00"), D("10.00"), -0.1), ("C2", "P1", "auto", "R", 2020, D("1.00"), None, -0.1)],
        "claim_id string, policy_id string, line_of_business string, region string, accident_year int, "
        "ultimate_cost_eur decimal(15,2), annual_premium_eur decimal(12,2), loss_ratio double",
    )
    assert [r.claim_id for r in quality.loss_ratio_positive(enriched).collect()] == ["C1"]


def test_orphans_null_rates_and_report(spark, tmp_path):
    claims = spark.createDataFrame([("C1", "P1"), ("C2", "P9")], "claim_id string, policy_id string")
    policies = spark.createDataFrame([("P1",)], "policy_id string")
    assert [r.claim_id for r in quality.orphan_claims(claims, policies).collect()] == ["C2"]
    rates = {r.column_name: r.null_rate for r in quality.null_rates("t", spark.createDataFrame([(1, None), (None, None)], "a int, b int")).collect()}
    assert rates == {"a": 0.5, "b": 1.0}
    res = spark.createDataFrame(
        [("s1", "t", "c", "not_null", 3, 0, True), ("s1", "t", "d", "unique", 3, 2, False), ("s2", "t", "c", "x", 3, 0, True)],
        "suite string, table_name string, column_name string, expectation string, evaluated long, unexpected long, success boolean",
    )
    summary = quality.suite_summary(res)
    by_suite = {r.suite: r for r in summary.collect()}
    assert by_suite["s1"].success is False and by_suite["s1"].unsuccessful_expectations == 1
    quality.write_report(summary, str(tmp_path / "report"))
    text = "".join(p.read_text() for p in (tmp_path / "report").glob("part-*"))
    doc = json.loads(text)
    assert doc["success"] is False
    assert doc["statistics"] == {"evaluated_expectations": 3, "successful_expectations": 2, "unsuccessful_expectations": 1}
    assert [v["expectation_suite_name"] for v in doc["validation_results"]] == ["s1", "s2"]


def test_merged_pass_matches_separate_checks(spark):
    """Row checks + uniqueness in one grouped pass give the same rows as separately."""
    tables = {"raw_claims": raw(spark, [row("C1"), row("C1"), row(None), row("C3", lob="Boat"), row("C4", paid="-1.00")])}
    checks = quality.claims_suite_checks()
    spec = quality.claims_suite_unique_spec()
    merged = sorted(quality.run_checks(tables, checks, spec).collect())
    separate = sorted(quality.run_row_checks(tables, checks).unionByName(quality.run_unique_checks(tables, spec)).collect())
    assert merged == separate


def test_singular_checks_as_row_predicates(spark):
    mart = spark.createDataFrame(
        [("auto", "R", 2020, D("20000.00"), 6.0, 3), ("home", "R", 2020, D("-1.00"), None, 1)],
        "line_of_business string, region string, accident_year int, earned_premium_eur decimal(18,2), loss_ratio double, claim_count bigint",
    )
    enriched = spark.createDataFrame([(D("10.00"), -0.5)], "annual_premium_eur decimal(12,2), loss_ratio double")
    got = {r.expectation: r.unexpected for r in quality.run_checks(
        {"mart_loss_ratio": mart, "int_claims_enriched": enriched}, quality.singular_checks()).collect()}
    assert got == {"singular:no_negative_premium": 1, "singular:loss_ratio_within_bounds": 1,
                   "singular:loss_ratio_positive": 1}


def test_column_sets_of_the_raw_layer(spark, sf_small):
    from actuaria.plans.registry import Layers
    from actuaria.sources.tables import RAW_CLAIMS_SCHEMA, RAW_POLICIES_SCHEMA

    L = Layers(spark, sf_small)
    assert quality.column_set_check("raw_policies", L.raw_policies, RAW_POLICIES_SCHEMA.names)["success"]
    assert quality.column_set_check("raw_claims", L.raw_claims, RAW_CLAIMS_SCHEMA.names)["success"]
    bad = quality.column_set_check("raw_claims", L.raw_claims.drop("reserve"), RAW_CLAIMS_SCHEMA.names)
    assert bad["missing"] == ["reserve"] and not bad["success"]


def test_median_rejects_too_wide_decimals(spark):
    import pytest

    from actuaria.operators.median import exact_median

    with pytest.raises(ValueError):
        exact_median(spark.range(1), ["id"], "id", precision=20)
