"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or data Spark derives from them) in full. Audit
clock columns are not emitted here (they are non-deterministic); the batch run adds
them when it writes the layers. Each call builds its own lazy layer graph, so that it
sees the files of that moment; a layer used twice in one query is the same subplan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actuaria.functions import bands, formatting, metrics
from actuaria.operators import accidents, dashboard, intermediate, marts, quality, segments, staging
from actuaria.session import materialize, scratch_path
from actuaria.sources import loaders, rawlayer
from actuaria.sources.generations import Generations

Query = Callable[[SparkSession, str], DataFrame]


class Layers:
    """Lazily built layers of one run over one scale-factor folder.

    ``_keep`` is the materialisation hook: here every layer stays a lazy DataFrame;
    :class:`actuaria.plans.batch.StoredLayers` writes each one once instead.
    """

    materialized = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        return df

    @cached_property
    def raw_policies(self) -> DataFrame:
        return self._keep("raw_policies", rawlayer.raw_policies(self.spark, self.sf_dir))

    @cached_property
    def raw_claims(self) -> DataFrame:
        return self._keep("raw_claims", rawlayer.raw_claims(self.spark, self.sf_dir))

    @cached_property
    def raw_contracts(self) -> DataFrame:
        return rawlayer.raw_contracts(self.spark)

    @cached_property
    def stg_policies(self) -> DataFrame:
        return self._keep("stg_policies", staging.stg_policies(self.raw_policies))

    @cached_property
    def stg_claims(self) -> DataFrame:
        return self._keep("stg_claims", staging.stg_claims(self.raw_claims))

    @cached_property
    def stg_contracts(self) -> DataFrame:
        return staging.stg_contracts(self.raw_contracts)

    @cached_property
    def enriched(self) -> DataFrame:
        return self._keep(
            "int_claims_enriched", intermediate.claims_enriched(self.stg_claims, self.stg_policies)
        )

    # Stored segment states, from which the marts roll up; a lazy run aggregates directly.
    seg_policies: DataFrame | None = None
    seg_claims: DataFrame | None = None

    @cached_property
    def portfolio(self) -> DataFrame:
        if self.seg_policies is not None:
            built = intermediate.portfolio_of(self.seg_policies, self.stg_contracts)
        else:
            built = intermediate.portfolio(self.stg_policies, self.stg_contracts)
        return self._keep("int_portfolio", built)

    @cached_property
    def portfolio_summary(self) -> DataFrame:
        built = intermediate.portfolio_summary(self.enriched, self.stg_claims, state=self.seg_claims)
        return self._keep("int_portfolio_summary", built)

    @cached_property
    def mart_loss_ratio(self) -> DataFrame:
        return self._keep("mart_loss_ratio", self._loss_ratio())

    def _loss_ratio(self) -> DataFrame:
        return marts.loss_ratio_mart(self.stg_policies, self.stg_claims)

    @cached_property
    def mart_claims_frequency(self) -> DataFrame:
        built = marts.claims_frequency_mart(
            self.enriched, self.stg_policies, materialize_input=not self.materialized,
            cost_bounds=self.cost_bounds, claims=self.seg_claims, policies=self.seg_policies,
        )
        return self._keep("mart_claims_frequency", built)

    @cached_property
    def mart_portfolio_performance(self) -> DataFrame:
        built = marts.portfolio_performance_mart(self.portfolio, self.enriched, self.seg_claims)
        return self._keep("mart_portfolio_performance", built)

    cost_bounds: tuple | None = None

    TABLE_ATTRIBUTES = {
        "raw_policies": "raw_policies",
        "raw_claims": "raw_claims",
        "stg_policies": "stg_policies",
        "stg_claims": "stg_claims",
        "stg_contracts": "stg_contracts",
        "int_claims_enriched": "enriched",
        "seg_policies": "seg_policies",
        "seg_claims": "seg_claims",
        "int_portfolio": "portfolio",
        "mart_loss_ratio": "mart_loss_ratio",
        "mart_claims_frequency": "mart_claims_frequency",
        "mart_portfolio_performance": "mart_portfolio_performance",
    }

    def tables(self) -> Mapping[str, DataFrame]:
        """Table name -> layer, built only when a check reads it."""
        layers = self

        class _Tables(Mapping):
            def __getitem__(self, name: str) -> DataFrame:
                return getattr(layers, Layers.TABLE_ATTRIBUTES[name])

            def __iter__(self):
                return iter(Layers.TABLE_ATTRIBUTES)

            def __len__(self) -> int:
                return len(Layers.TABLE_ATTRIBUTES)

        return _Tables()


QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Callable[[Layers], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Layers(spark, sf_dir))
        return fn

    return register


# ---- models -----------------------------------------------------------------------------


@query("loss_ratio")
def _loss_ratio(L: Layers) -> DataFrame:
    return L.mart_loss_ratio.orderBy(*marts.loss_ratio_order())


@query("stg_policies")
def _stg_policies(L: Layers) -> DataFrame:
    return L.stg_policies


@query("stg_claims")
def _stg_claims(L: Layers) -> DataFrame:
    return L.stg_claims


@query("claims_enriched")
def _claims_enriched(L: Layers) -> DataFrame:
    return L.enriched


@query("portfolio")
def _portfolio(L: Layers) -> DataFrame:
    return L.portfolio


@query("portfolio_summary")
def _portfolio_summary(L: Layers) -> DataFrame:
    return L.portfolio_summary.orderBy(*intermediate.summary_order())


@query("claims_frequency")
def _claims_frequency(L: Layers) -> DataFrame:
    # built afresh on every call: its input is materialised, and a repeated query must
    # read the current tables, not a previous call's copy
    mart = marts.claims_frequency_mart(L.enriched, L.stg_policies)
    return mart.orderBy(*marts.frequency_order())


@query("portfolio_performance")
def _portfolio_performance(L: Layers) -> DataFrame:
    return L.mart_portfolio_performance.orderBy(*marts.performance_order())


def _wide_sums(state: DataFrame) -> DataFrame:
    """One decimal width for every sum, whatever its terms had."""
    return state.withColumns({c: F.col(c).cast("decimal(38,2)") for c, t in state.dtypes if c.endswith("_sum") and "decimal" in t})


@query("segment_claims")
def _segment_claims(L: Layers) -> DataFrame:
    """The mergeable segment state of the enriched claims."""
    return _wide_sums(segments.claims_state(L.enriched))


@query("segment_policies")
def _segment_policies(L: Layers) -> DataFrame:
    """The mergeable segment state of the staged policies."""
    return _wide_sums(segments.policies_state(L.stg_policies))


@query("distinct_policies_rollup")
def _distinct_policies_rollup(L: Layers) -> DataFrame:
    """Policies with claims per (lob, region, year), (lob, year), lob and in all, rolled up from
    one stored state (``level``: how many of the three keys a row has)."""
    stored = materialize(segments.policy_bitmaps(L.stg_claims), "policy-bitmaps")
    kinds = {f.name: f.dataType for f in stored.schema}
    levels = []
    for keys in (segments.SEEN_KEYS, ["line_of_business", "accident_year"], ["line_of_business"], []):
        counted = segments.distinct_policies(stored, keys)
        levels.append(counted.select(
            F.lit(len(keys)).alias("level"),
            *(F.col(c) if c in keys else F.lit(None).cast(kinds[c]).alias(c) for c in segments.SEEN_KEYS),
            "policy_count",
        ))
    return reduce(DataFrame.unionByName, levels)


@query("loss_ratio_from_segments")
def _loss_ratio_from_segments(L: Layers) -> DataFrame:
    """The loss-ratio mart rolled up from the two stored segment states.

    The enriched claims have one reader here, the claims' state: they go into it as they are
    joined, without a table between, so that the join carries only what the state measures."""
    from actuaria.plans.batch import STATES, StoredLayers

    stored = StoredLayers(L.spark, L.sf_dir, stored=STATES | {"stg_policies", "stg_claims"}).build()
    return stored.mart_loss_ratio.orderBy(*marts.loss_ratio_order())


# ---- dashboard ----------------------------------------------------------------------------


@query("default_years")
def _default_years(L: Layers) -> DataFrame:
    return dashboard.default_years(L.mart_loss_ratio)


@query("filter_options")
def _filter_options(L: Layers) -> DataFrame:
    return dashboard.filter_options(L.mart_loss_ratio)


@query("dashboard_filter")
def _dashboard_filter(L: Layers) -> DataFrame:
    """One LOB, an explicit year list and the alert toggle on."""
    f = dashboard.DashboardFilter(lob="auto", years=(1996, 1997, 1998), alerts_only=True)
    return dashboard.apply_filter(L.mart_loss_ratio, f)


@query("kpi_cards")
def _kpi_cards(L: Layers) -> DataFrame:
    return dashboard.kpi_cards(dashboard.default_view(L.mart_loss_ratio))


@query("kpi_cards_text")
def _kpi_cards_text(L: Layers) -> DataFrame:
    return dashboard.kpi_cards_text(dashboard.kpi_cards(dashboard.default_view(L.mart_loss_ratio)))


@query("lob_loss_ratio")
def _lob_loss_ratio(L: Layers) -> DataFrame:
    return dashboard.lob_loss_ratio(dashboard.default_view(L.mart_loss_ratio))


@query("region_frequency")
def _region_frequency(L: Layers) -> DataFrame:
    return dashboard.region_frequency(dashboard.default_view(L.mart_loss_ratio))


@query("loss_ratio_trend")
def _loss_ratio_trend(L: Layers) -> DataFrame:
    return dashboard.loss_ratio_trend(L.mart_loss_ratio)


@query("alerts")
def _alerts(L: Layers) -> DataFrame:
    return dashboard.alerts(L.mart_loss_ratio)


@query("alerts_text")
def _alerts_text(L: Layers) -> DataFrame:
    return dashboard.alerts_text(dashboard.alerts(L.mart_loss_ratio))


@query("actuarial_summary")
def _actuarial_summary(L: Layers) -> DataFrame:
    return dashboard.actuarial_summary(L.raw_policies, L.raw_claims)


# ---- data quality ---------------------------------------------------------------------------


@query("qa_not_null")
def _qa_not_null(L: Layers) -> DataFrame:
    """Not-null tests of every layer, marts included: counted by the writes of the layers
    (each built once, as in a pipeline run)."""
    from actuaria.plans.batch import SHARED_FOR_CHECKS, StoredLayers

    checks = quality.schema_not_null_checks() + [
        c for c in quality.claims_suite_checks() if c.expectation == "not_null"
    ]
    stored = StoredLayers(L.spark, L.sf_dir, stored=SHARED_FOR_CHECKS).build()
    return quality.run_row_checks(stored.tables(), checks, stored.counted)


@query("qa_unique")
def _qa_unique(L: Layers) -> DataFrame:
    spec = quality.schema_unique_spec() + quality.claims_suite_unique_spec()
    return quality.run_unique_checks(L.tables(), spec)


@query("qa_accepted_values")
def _qa_accepted_values(L: Layers) -> DataFrame:
    checks = quality.schema_accepted_checks() + [
        c for c in quality.claims_suite_checks() if c.expectation == "accepted_values"
    ]
    return quality.run_row_checks(L.tables(), checks)


@query("qa_between")
def _qa_between(L: Layers) -> DataFrame:
    checks = [c for c in quality.claims_suite_checks() if c.expectation == "between"]
    return quality.run_row_checks(L.tables(), checks)


@query("qa_pair_order")
def _qa_pair_order(L: Layers) -> DataFrame:
    checks = [c for c in quality.claims_suite_checks() if c.expectation == "a_greater_than_b"]
    return quality.run_row_checks(L.tables(), checks)


@query("qa_invariants")
def _qa_invariants(L: Layers) -> DataFrame:
    return quality.run_row_checks(L.tables(), quality.invariant_checks())


@query("qa_staged_cost")
def _qa_staged_cost(L: Layers) -> DataFrame:
    return quality.run_row_checks(L.tables(), quality.staged_cost_checks())


@query("qa_failing_claims")
def _qa_failing_claims(L: Layers) -> DataFrame:
    """The raw claims that fail a check of their suite, one row per claim and check."""
    tables = L.tables()
    found = [
        quality.failing_rows(tables, c).select(
            F.lit(c.column).alias("column_name"), F.lit(c.expectation).alias("expectation"),
            "claim_id", "policy_id", "claim_date", "reporting_date", "paid_amount",
        )
        for c in quality.claims_suite_checks()
        if c.expectation in ("not_null", "between", "a_greater_than_b")
    ]
    return reduce(DataFrame.unionByName, found)


@query("qa_no_negative_premium")
def _qa_no_negative_premium(L: Layers) -> DataFrame:
    return quality.no_negative_premium(L.mart_loss_ratio)


@query("qa_lr_bounds")
def _qa_lr_bounds(L: Layers) -> DataFrame:
    return quality.loss_ratio_within_bounds(L.mart_loss_ratio)


@query("qa_lr_positive")
def _qa_lr_positive(L: Layers) -> DataFrame:
    return quality.loss_ratio_positive(L.enriched)


@query("qa_claim_count")
def _qa_claim_count(L: Layers) -> DataFrame:
    return quality.claim_count_consistency(L.mart_loss_ratio, L.stg_claims)


@query("qa_orphan_claims")
def _qa_orphan_claims(L: Layers) -> DataFrame:
    return quality.orphan_claims(L.stg_claims, L.stg_policies)


@query("qa_null_rate")
def _qa_null_rate(L: Layers) -> DataFrame:
    return quality.null_rates("raw_policies", L.raw_policies).unionByName(
        quality.null_rates("raw_claims", L.raw_claims)
    )


def all_quality_results(L: Layers) -> DataFrame:
    """Every declared check, one row each: row-local checks come from the writes of stored
    layers, else from one pass per table; the single-table singular tests are row predicates
    among them; the cross-table claim-count reconciliation is its own small query."""
    t = L.tables()
    row_checks = quality.gate_checks()
    unique = quality.gate_unique_spec()
    reconciliation = (
        quality.claim_count_consistency(L.mart_loss_ratio, L.stg_claims)
        .agg(F.count(F.lit(1)).alias("unexpected"))
        .select(
            F.lit(quality.SCHEMA_TESTS).alias("suite"),
            F.lit("mart_loss_ratio,stg_claims").alias("table_name"),
            F.lit("claim_count").alias("column_name"),
            F.lit("singular:claim_count_consistency").alias("expectation"),
            F.lit(1).cast("bigint").alias("evaluated"),
            "unexpected",
            (F.col("unexpected") == 0).alias("success"),
        )
    )
    counted, found = getattr(L, "counted", None), getattr(L, "unique_found", None)
    return quality.run_checks(t, row_checks, unique, counted, found).unionByName(reconciliation)


@query("quality_report")
def _quality_report(L: Layers) -> DataFrame:
    """The quality gate as in a batch run: every layer is written once, its row checks
    counted by that write; only uniqueness (checked while later layers are written) and the
    reconciliation read a layer again."""
    from actuaria.plans.batch import SHARED_FOR_CHECKS, StoredLayers

    stored = StoredLayers(L.spark, L.sf_dir, stored=SHARED_FOR_CHECKS).build(unique=quality.gate_unique_spec())
    return quality.suite_summary(all_quality_results(stored))


# ---- accidents ------------------------------------------------------------------------------


@query("accidents_enriched")
def _accidents_enriched(L: Layers) -> DataFrame:
    files = rawlayer.accident_files(L.spark, L.sf_dir)
    return accidents.enrich_accidents(files["caract"], files["lieux"], files["usag"], files["vehic"])


@query("accidents_preview")
def _accidents_preview(L: Layers) -> DataFrame:
    """The first five rows of the enriched accidents, in a total order: a preview is a limit."""
    files = rawlayer.accident_files(L.spark, L.sf_dir)
    enriched = accidents.enrich_accidents(files["caract"], files["lieux"], files["usag"], files["vehic"])
    order = [F.asc_nulls_last(c) for c in ("annee", "accident_id", "type_voie", "etat_surface")]
    return enriched.orderBy(*order).limit(5)


def _landed_accidents(L: Layers) -> str:
    """The accident files of the tables, written whole as CSV folders by kind and year."""
    root = scratch_path(L.spark, f"accidents-{uuid.uuid4().hex}")
    accidents.write_accident_source(rawlayer.accident_files(L.spark, L.sf_dir), root)
    return root


@query("accidents_csv")
def _accidents_csv(L: Layers) -> DataFrame:
    """The same accident files landed as ``;``/ISO-8859-1 CSV by kind and year, every year read back."""
    return accidents.enrich_source(accidents.read_accident_source(L.spark, _landed_accidents(L)))


@query("accidents_latest_years")
def _accidents_latest_years(L: Layers) -> DataFrame:
    """The two latest years of the landed files: the folders of the other years are not read."""
    root = _landed_accidents(L)
    header = accidents.read_accident_source(L.spark, root, kinds=("caract",))["caract"]
    latest = header.where(F.col("annee").isNotNull()).select("annee").distinct().orderBy(F.desc("annee")).limit(2)
    years = [r["annee"] for r in latest.collect()]
    return accidents.enrich_source(accidents.read_accident_source(L.spark, root, years))


# ---- loaders and materialisation --------------------------------------------------------------


@query("load_all_counts")
def _load_all_counts(L: Layers) -> DataFrame:
    """Row counts ``(table_name, rows)`` of the raw files that the loader put into a
    database of its own; there is no treaty file here, and a missing file is skipped."""
    folder = scratch_path(L.spark, f"raw-all-{uuid.uuid4().hex}")
    for name, df in (("policies", L.raw_policies), ("claims", L.raw_claims)):
        loaders.write_table(df, f"{folder}/{name}.parquet")
    database = f"raw_{uuid.uuid4().hex[:8]}"
    counts = loaders.load_all_raw(L.spark, folder, database=database)
    L.spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return L.spark.createDataFrame(sorted(counts.items()), "table_name string, rows long")


def _loaded(L: Layers, table: str) -> DataFrame:
    """A loaded table by its name, which is then taken out of the catalog again (the rows stay)."""
    df = L.spark.table(f"`{loaders.RAW_DATABASE}`.`{table}`")
    loaders.drop(L.spark, table, files=False)
    return df


@query("load_parquet")
def _load_parquet(L: Layers) -> DataFrame:
    """Raw policies written as Parquet, loaded (twice: replace, not append) into the
    ``raw`` database, read back from the catalog."""
    path = scratch_path(L.spark, f"raw-policies-{uuid.uuid4().hex}")
    loaders.write_table(L.raw_policies, path)
    table = f"policies_{uuid.uuid4().hex[:8]}"
    loaders.load_parquet(L.spark, path, table)
    loaders.load_parquet(L.spark, path, table)
    return _loaded(L, table)


@query("load_csv")
def _load_csv(L: Layers) -> DataFrame:
    """Raw claims written as headed CSV, loaded with the types found on its sample into ``raw``."""
    path = scratch_path(L.spark, f"raw-claims-csv-{uuid.uuid4().hex}")
    loaders.write_csv(L.raw_claims, path, sep=",", encoding="UTF-8")
    table = f"claims_csv_{uuid.uuid4().hex[:8]}"
    loaders.load_csv(L.spark, path, table)
    return _loaded(L, table)


@query("load_csv_dialect")
def _load_csv_dialect(L: Layers) -> DataFrame:
    """Raw claims as a tab-separated ISO-8859-1 file with every value quoted, decimal commas and
    day-first dates, loaded without being told any of it; rejected records stay in a column."""
    path = scratch_path(L.spark, f"raw-claims-tsv-{uuid.uuid4().hex}")
    text = {"decimal": lambda c: F.translate(F.col(c).cast("string"), ".", ","), "date": lambda c: F.date_format(c, "dd/MM/yyyy")}
    columns = [
        next((to(f.name) for kind, to in text.items() if f.dataType.typeName() == kind), F.col(f.name)).alias(f.name)
        for f in L.raw_claims.schema
    ]
    written = L.raw_claims.select(*columns).write.option("quoteAll", True).option("header", True)
    written.option("sep", "\t").option("encoding", "ISO-8859-1").csv(path)
    table = f"claims_tsv_{uuid.uuid4().hex[:8]}"
    loaders.load_csv(L.spark, path, table, rejects="_rejected")
    return _loaded(L, table)


@query("loss_ratio_from_files")
def _loss_ratio_from_files(L: Layers) -> DataFrame:
    """The flagship mart from raw Parquet files (policies, claims, contracts), the
    input a switching user has: the raw layer is written as those files first."""
    from actuaria.plans.batch import FileLayers

    folder = scratch_path(L.spark, f"raw-files-{uuid.uuid4().hex}")
    for name, df in (("policies", L.raw_policies), ("claims", L.raw_claims), ("contracts", L.raw_contracts)):
        loaders.write_table(df, f"{folder}/{name}.parquet")
    return FileLayers(L.spark, folder).mart_loss_ratio.orderBy(*marts.loss_ratio_order())


@query("marts_roundtrip")
def _marts_roundtrip(L: Layers) -> DataFrame:
    """The loss-ratio mart materialised as a Parquet table and read back whole."""
    path = scratch_path(L.spark, f"mart-loss-ratio-{uuid.uuid4().hex}")
    loaders.write_table(L.mart_loss_ratio, path)
    return loaders.read_table(L.spark, path)


@query("marts_current")
def _marts_current(L: Layers) -> DataFrame:
    """The loss-ratio mart rebuilt twice as generations of one home, read through the
    marker of the current one; the first generation is retired by the second."""
    home = Generations(L.spark, scratch_path(L.spark, f"marts-{uuid.uuid4().hex}"))
    home.replace({"mart_loss_ratio": L.mart_loss_ratio})
    home.replace({"mart_loss_ratio": L.mart_loss_ratio})
    with home.reading() as now:
        return now.table("mart_loss_ratio")


@query("asset_listing")
def _asset_listing(L: Layers) -> DataFrame:
    """The data assets of the given folder, from file metadata alone."""
    return loaders.discover_assets(L.spark, L.sf_dir).select("asset").distinct()


@query("stream_staged_claims")
def _stream_staged_claims(L: Layers) -> DataFrame:
    """Raw claims landed as Parquet files, staged by the incremental (streaming) path
    in one availableNow run, read back from its sink."""
    from actuaria.streaming import stage_incrementally

    run = scratch_path(L.spark, f"stream-{uuid.uuid4().hex}")
    loaders.write_table(L.raw_claims, f"{run}/landing")
    return stage_incrementally(L.spark, "claims", f"{run}/landing", f"{run}/staged", f"{run}/checkpoint")


# ---- scalar functions applied to the data ----------------------------------------------------


@query("claim_metrics")
def _claim_metrics(L: Layers) -> DataFrame:
    e = L.enriched
    return e.select(
        "claim_id",
        metrics.loss_ratio("ultimate_cost_eur", "annual_premium_eur", 2).alias("loss_ratio_2dp"),
        metrics.safe_divide("paid_amount_eur", "ultimate_cost_eur", 4).alias("paid_to_incurred"),
        metrics.safe_divide(
            F.col("reserve_eur") - F.col("paid_amount_eur"), "ultimate_cost_eur", 6
        ).alias("net_reserve_share"),
        metrics.cents_to_euros((F.col("ultimate_cost_eur") * 100).cast("bigint")).alias(
            "ultimate_from_cents"
        ),
        metrics.combined_ratio("ultimate_cost_eur", "outstanding_reserve_eur", "annual_premium_eur").alias(
            "cost_and_outstanding_ratio"
        ),
    )


@query("policy_status_asof")
def _policy_status_asof(L: Layers) -> DataFrame:
    as_of = F.lit("2000-12-31").cast("date")
    return L.stg_policies.select(
        "policy_id", "expiry_date", bands.policy_status_asof("expiry_date", as_of).alias("status_asof")
    )


@query("claim_status_rule")
def _claim_status_rule(L: Layers) -> DataFrame:
    return L.stg_claims.select(
        "claim_id",
        "paid_amount_eur",
        "ultimate_cost_eur",
        bands.claim_status_rule("paid_amount_eur", "ultimate_cost_eur").alias("status_by_payment"),
    )


@query("year_spine")
def _year_spine(L: Layers) -> DataFrame:
    """Every year between the first and last inception year (gap-free axis)."""
    bounds = L.stg_policies.agg(F.min("inception_year").alias("a"), F.max("inception_year").alias("b"))
    return bounds.select(formatting.year_spine("a", "b"))


@query("ceded_losses")
def _ceded_losses(L: Layers) -> DataFrame:
    """Gross / ceded / net losses per (lob, year) under the treaties in force on the
    claim date (claims outside every treaty's period cede nothing)."""
    from actuaria.operators import reinsurance

    return reinsurance.ceded_by_segment(L.stg_claims, L.stg_contracts)


@query("frequency_vs_expected")
def _frequency_vs_expected(L: Layers) -> DataFrame:
    """Observed claim frequency against the actuarial base rate per segment."""
    from actuaria.operators import experience

    return experience.observed_vs_expected(L.mart_loss_ratio)


@query("herfindahl_index")
def _herfindahl_index(L: Layers) -> DataFrame:
    """Claims concentration across regions per (lob, year): the sum of squared
    regional shares, computed exactly as sum(n^2) / (sum n)^2 in one aggregation."""
    n = F.col("claim_count").cast("decimal(20,0)")
    totals = L.portfolio_summary.groupBy("line_of_business", "accident_year").agg(
        F.sum(n * n).alias("_squares"), F.sum(n).alias("_total")
    )
    return totals.select(
        "line_of_business",
        "accident_year",
        metrics.round_half_up(
            metrics.ratio("_squares", F.col("_total") * F.col("_total")), 6
        ).alias("herfindahl_index"),
    )
