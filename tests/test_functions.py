from decimal import Decimal

from pyspark.sql import functions as F

from actuaria.functions import (
    age_segment,
    burning_cost,
    cents_to_euros,
    claim_status_rule,
    combined_ratio,
    high_loss_ratio_flag,
    ibnr_candidate,
    loss_ratio,
    policy_status_asof,
    round_half_away,
    round_half_up,
    safe_divide,
    severity_band,
    traffic_light,
    year_spine,
)


def one_col(spark, values, ddl):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_age_bands_at_boundaries(spark):
    ages = [17, 18, 25, 26, 40, 41, 60, 61, None]
    got = [r[0] for r in one_col(spark, ages, "a int").select(age_segment("a")).collect()]
    assert got == [
        "Unknown", "Young Driver", "Young Driver", "26-40", "26-40", "41-60", "41-60", "Senior", "Unknown",
    ]


def test_severity_bands_are_half_open(spark):
    costs = [Decimal("999.99"), Decimal("1000"), Decimal("9999.99"), Decimal("10000"), Decimal("100000")]
    got = [r[0] for r in one_col(spark, costs, "c decimal(15,2)").select(severity_band("c")).collect()]
    assert got == ["Small", "Medium", "Medium", "Large", "Severe"]


def test_ibnr_flag_lag_30_31_and_null(spark):
    got = [r[0] for r in one_col(spark, [30, 31, None], "l int").select(ibnr_candidate("l")).collect()]
    assert got == [False, True, False]


def test_loss_ratio_guards_zero_null_and_negative_premium(spark):
    df = spark.createDataFrame(
        [(Decimal("50"), Decimal("200")), (Decimal("50"), Decimal("0")), (Decimal("50"), None), (Decimal("50"), Decimal("-10"))],
        "l decimal(15,2), p decimal(15,2)",
    )
    got = [r[0] for r in df.select(loss_ratio("l", "p")).collect()]
    assert got == [0.25, None, None, None]


def test_safe_divide_divides_by_negative_denominator(spark):
    df = spark.createDataFrame([(1.0, -3.0), (1.0, 0.0), (1.0, None), (2.0, 3.0)], "n double, d double")
    got = [r[0] for r in df.select(safe_divide("n", "d")).collect()]
    assert got == [-0.3333, None, None, 0.6667]


def test_burning_cost_and_combined_ratio(spark):
    df = spark.createDataFrame([(Decimal("1000"), 0.5, Decimal("100"), Decimal("2000"))], "l decimal(15,2), e double, x decimal(15,2), p decimal(15,2)")
    row = df.select(
        burning_cost("l", "e").alias("bc"),
        burning_cost("l", F.lit(0.0)).alias("bc0"),
        combined_ratio("l", "x", "p").alias("cr"),
        combined_ratio("l", "x", F.lit(0)).alias("cr0"),
    ).first()
    assert row.bc == Decimal("2000.00") and row.bc0 is None
    assert row.cr == 0.55 and row.cr0 is None


def test_cents_to_euros(spark):
    got = one_col(spark, [12345, 1, None], "c bigint").select(cents_to_euros("c")).collect()
    assert [r[0] for r in got] == [Decimal("123.45"), Decimal("0.01"), None]


def test_rounding_halves(spark):
    df = one_col(spark, [2.5, -2.5, 0.125, 1.005], "x double")
    away = [r[0] for r in df.select(round_half_away("x", 0)).collect()]
    assert away == [3.0, -3.0, 0.0, 1.0]
    up2 = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert up2[2] == 0.13


def test_high_loss_ratio_flag_and_traffic_light(spark):
    df = spark.createDataFrame(
        [(Decimal("86"), Decimal("100")), (Decimal("85"), Decimal("100")), (Decimal("10"), Decimal("0"))],
        "l decimal(15,2), p decimal(15,2)",
    )
    assert [r[0] for r in df.select(high_loss_ratio_flag("l", "p")).collect()] == [True, False, False]
    lights = one_col(spark, [0.86, 0.85, 0.70, 0.69], "x double").select(traffic_light("x")).collect()
    assert [r[0] for r in lights] == ["red", "amber", "amber", "green"]


def test_status_rules(spark):
    df = spark.sql("select date'2024-01-02' as e, date'2024-01-01' as a, 90.0d as paid, 100.0d as ult")
    row = df.select(policy_status_asof("e", "a").alias("s"), claim_status_rule("paid", "ult").alias("c")).first()
    assert row.s == "Active" and row.c == "Closed"
    row = df.select(policy_status_asof("a", "e").alias("s"), claim_status_rule(F.lit(89.0), "ult").alias("c")).first()
    assert row.s == "Expired" and row.c == "Open"


def test_year_spine(spark):
    got = spark.sql("select 2021 as a, 2024 as b").select(year_spine("a", "b")).collect()
    assert [r.year_value for r in got] == [2021, 2022, 2023, 2024]


def test_alert_and_card_formatting(spark):
    from actuaria.operators.dashboard import alerts_text

    df = spark.createDataFrame(
        [("auto", "R", 2020, 0.8667, Decimal("1234567.49"), 3)],
        "line_of_business string, region string, accident_year int, loss_ratio double, "
        "earned_premium_eur decimal(18,2), claim_count bigint",
    )
    row = alerts_text(df).first()
    assert row.loss_ratio == "86.7%" and row.earned_premium_eur == "€1,234,567"
