"""Dashboard panels on a hand-written loss-ratio mart."""

from decimal import Decimal as D

from actuaria.operators import dashboard

COLS = (
    "line_of_business string, region string, accident_year int, policy_count bigint, "
    "earned_premium_eur decimal(18,2), claim_count bigint, incurred_losses_eur decimal(18,2), "
    "ibnr_claims_count bigint, loss_ratio double, high_loss_ratio_flag boolean"
)


def mart(spark):
    return spark.createDataFrame(
        [
            ("auto", "A", 2021, 10, D("1000.00"), 2, D("900.00"), 1, 0.9, True),
            ("auto", "B", 2020, 5, D("500.00"), 1, D("100.00"), 0, 0.2, False),
            ("home", "A", 2021, 0, D("0.00"), 1, D("50.00"), 1, None, False),
            ("home", "B", 2019, 4, D("400.00"), 0, D("0.00"), 0, 0.0, False),
        ],
        COLS,
    )


def test_filters_and_default_years(spark):
    m = mart(spark)
    assert sorted(r.accident_year for r in dashboard.default_years(m).collect()) == [2020, 2021]
    assert dashboard.default_view(m).count() == 3
    f = dashboard.DashboardFilter(lob=dashboard.ALL_LINES, years=(), alerts_only=False)
    assert dashboard.apply_filter(m, f).count() == 4  # "all" and an empty year list bypass
    f = dashboard.DashboardFilter(lob="auto", years=(2020, 2021), alerts_only=True)
    assert [r.region for r in dashboard.apply_filter(m, f).collect()] == ["A"]


def test_panels_handle_zero_premium(spark):
    m = mart(spark)
    lobs = {r.line_of_business: r.loss_ratio for r in dashboard.lob_loss_ratio(dashboard.default_view(m)).collect()}
    assert lobs["home"] is None and abs(lobs["auto"] - 1000 / 1500) < 1e-12
    regions = [r.region for r in dashboard.region_frequency(m).collect()]
    assert regions[0] == "A"  # (2 + 1) / 10 claims per policy, highest first
    trend = {(r.accident_year, r.line_of_business): r.lr for r in dashboard.loss_ratio_trend(m).collect()}
    assert trend[(2021, "home")] is None and trend[(2019, "home")] == 0.0
    assert [r.region for r in dashboard.alerts(m).collect()] == ["A"]


def test_kpi_cards_without_premium_fall_back_to_zero(spark):
    empty = mart(spark).where("earned_premium_eur = 0")
    k = dashboard.kpi_cards(empty).first()
    assert k.overall_loss_ratio == 0.0 and k.overall_frequency == 0.0 and k.loss_ratio_light == "green"
    k = dashboard.kpi_cards(mart(spark)).first()
    assert k.total_premium_eur == D("1900.00") and k.loss_ratio_light == "green"  # 1050 / 1900 < 0.70
    text = dashboard.kpi_cards_text(dashboard.kpi_cards(mart(spark))).first()
    assert text.loss_ratio_text == "55.3%" and text.premium_text == "€0.0M"


def test_filter_options(spark):
    rows = [(r.selector, r.value) for r in dashboard.filter_options(mart(spark)).collect()]
    assert rows == [
        ("accident_year", "2021"), ("accident_year", "2020"), ("accident_year", "2019"),
        ("line_of_business", dashboard.ALL_LINES), ("line_of_business", "auto"), ("line_of_business", "home"),
    ]
