"""Data-quality checks as aggregates.

Every column check yields one row
``(suite, table_name, column_name, expectation, evaluated, unexpected, success)``.
All row-local checks on one table are counters (``count_if`` per check) observed by the
write of that table, or ONE aggregation pass over it; a uniqueness check is one grouped count on its key (partial counts per map
task, so a very frequent key costs one row per task). Singular tests return the
offending rows, and pass when there are none.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from actuaria.functions.bands import LINES_OF_BUSINESS, LR_SANITY_BOUND, LR_SANITY_MIN_PREMIUM

SCHEMA_TESTS = "model_schema_tests"
CLAIMS_SUITE = "claims_quality_suite"

# ---- fixed values: declared column tests ----------------------------------------
NOT_NULL = {
    "stg_policies": ["policy_id", "annual_premium_eur", "line_of_business", "inception_date"],
    "stg_claims": ["claim_id", "policy_id", "ultimate_cost_eur", "line_of_business"],
    "stg_contracts": ["contract_id", "line_of_business"],
    "int_claims_enriched": ["claim_id", "policy_id"],
    "int_portfolio": ["line_of_business"],
    "mart_loss_ratio": ["line_of_business", "accident_year", "earned_premium_eur"],
    "mart_claims_frequency": ["line_of_business", "accident_year"],
    "mart_portfolio_performance": ["line_of_business", "total_premium_eur"],
}
UNIQUE = {
    "stg_policies": ["policy_id"],
    "stg_claims": ["claim_id"],
    "stg_contracts": ["contract_id"],
    "int_claims_enriched": ["claim_id"],
}
STAGED_LINES = ("auto", "home", "liability", "health")
ACCEPTED = {
    ("stg_policies", "line_of_business"): STAGED_LINES,
    ("stg_claims", "line_of_business"): STAGED_LINES,
}
CLAIM_STATUSES = ("Open", "Closed")
# ---------------------------------------------------------------------------------


@dataclass(frozen=True, eq=False)
class RowCheck:
    """A check decided row by row: ``unexpected`` is true for a failing row."""

    suite: str
    table: str
    column: str
    expectation: str
    unexpected: Column

    @property
    def key(self) -> tuple[str, str, str, str]:
        return self.suite, self.table, self.column, self.expectation


def not_null(suite: str, table: str, column: str) -> RowCheck:
    return RowCheck(suite, table, column, "not_null", F.col(column).isNull())


def in_set(suite: str, table: str, column: str, values) -> RowCheck:
    c = F.col(column)
    return RowCheck(suite, table, column, "accepted_values", c.isNotNull() & ~c.isin(list(values)))


def between(
    suite: str, table: str, column: str, min_value=None, max_value=None, strict_min=False
) -> RowCheck:
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ((c <= min_value) if strict_min else (c < min_value))
    if max_value is not None:
        bad = bad | (c > max_value)
    return RowCheck(suite, table, column, "between", c.isNotNull() & bad)


def pair_greater(suite: str, table: str, a: str, b: str, or_equal: bool = True) -> RowCheck:
    ca, cb = F.col(a), F.col(b)
    bad = (ca < cb) if or_equal else (ca <= cb)
    return RowCheck(suite, table, f"{a},{b}", "a_greater_than_b", ca.isNotNull() & cb.isNotNull() & bad)


RESULT_COLUMNS = ["suite", "table_name", "column_name", "expectation", "evaluated", "unexpected", "success"]
RESULT_SCHEMA = (
    "suite string, table_name string, column_name string, expectation string, evaluated long, unexpected long, "
    "success boolean"
)


def _result_rows(agg: DataFrame, checks: list[RowCheck]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(ch.suite).alias("suite"),
                F.lit(ch.table).alias("table_name"),
                F.lit(ch.column).alias("column_name"),
                F.lit(ch.expectation).alias("expectation"),
                F.col("_rows").alias("evaluated"),
                F.col(f"_u{i}").alias("unexpected"),
            )
            for i, ch in enumerate(checks)
        ]
    )
    return (
        agg.select(F.inline(rows))
        .withColumn("success", F.col("unexpected") == 0)
        .select(*RESULT_COLUMNS)
    )


def counters(checks: list[RowCheck]) -> list[Column]:
    """Aggregates that decide the row checks of one table: its rows, and the failing ones of each check."""
    return [
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.coalesce(ch.unexpected, F.lit(False))).alias(f"_u{i}") for i, ch in enumerate(checks)],
    ]


class SeenTogether:
    """What the writes of a table's parts observed, as of one write: sums, but the least and the greatest value."""

    MERGE = {"_least": min, "_most": max}

    def __init__(self, parts: list[Observation]):
        self.parts = parts

    @property
    def get(self) -> dict:
        seen = [part.get for part in self.parts]
        known = {name: [s[name] for s in seen if s[name] is not None] for name in seen[0]}
        return {name: self.MERGE.get(name, sum)(values) if values else None for name, values in known.items()}


@dataclass
class Counted:
    """Counters of one table's row checks, collected by the write that read its rows anyway."""

    checks: list[RowCheck]
    seen: Observation | SeenTogether

    @classmethod
    def on(cls, df: DataFrame, checks: list[RowCheck], *more: Column) -> tuple[DataFrame, Counted]:
        """``df`` with the counters (and ``more`` aggregates) observed by its next action."""
        counted = cls(checks, Observation())
        return df.observe(counted.seen, *counters(checks), *more), counted

    @classmethod
    def together(cls, parts: list[Counted]) -> Counted:
        """The counters of a table from those of its parts."""
        return parts[0] if len(parts) == 1 else cls(parts[0].checks, SeenTogether([p.seen for p in parts]))

    def rows(self) -> int:
        return int(self.seen.get["_rows"])

    def decides(self, check: RowCheck) -> bool:
        return any(ch.key == check.key for ch in self.checks)

    def results(self, spark: SparkSession, checks: list[RowCheck]) -> DataFrame:
        """Result rows of ``checks``, from the numbers alone."""
        found = {ch.key: int(self.seen.get[f"_u{i}"]) for i, ch in enumerate(self.checks)}
        rows = [
            (ch.suite, ch.table, ch.column, ch.expectation, self.rows(), found[ch.key], found[ch.key] == 0)
            for ch in checks
        ]
        return spark.createDataFrame(rows, RESULT_SCHEMA)


def run_row_checks(
    tables: Mapping[str, DataFrame], checks: list[RowCheck], counted: Mapping[str, Counted] | None = None
) -> DataFrame:
    """All row-local checks. A table whose write carried the counters (``counted``, filled as
    the layers are built) is not read; of any other the counters are one aggregation pass."""
    counted = {} if counted is None else counted
    frames = []
    for table in dict.fromkeys(ch.table for ch in checks):
        df = tables[table]  # builds a stored layer, and with it its counters
        mine = [ch for ch in checks if ch.table == table]
        known = [ch for ch in mine if table in counted and counted[table].decides(ch)]
        if known:
            frames.append(counted[table].results(df.sparkSession, known))
        rest = [ch for ch in mine if ch not in known]
        if rest:
            frames.append(_result_rows(df.agg(*counters(rest)), rest))
    return reduce(DataFrame.unionByName, frames)


def failing_rows(tables: Mapping[str, DataFrame], check: RowCheck) -> DataFrame:
    """The rows of a table that a row check calls unexpected, all columns."""
    return tables[check.table].where(F.coalesce(check.unexpected, F.lit(False)))


def unique_check(suite: str, table: str, df: DataFrame, column: str) -> DataFrame:
    """Rows whose non-NULL value occurs more than once (all occurrences count)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    agg = counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("_rows"),
        F.coalesce(F.sum(F.when(F.col(column).isNotNull() & (F.col("_n") > 1), F.col("_n"))), F.lit(0))
        .cast("bigint")
        .alias("_u0"),
    )
    return _result_rows(agg, [RowCheck(suite, table, column, "unique", F.lit(False))])


def added_up(parts: list[Row]) -> Row:
    """The result row of a check from those of a table's parts."""
    evaluated, unexpected = (sum(r[c] for r in parts) for c in ("evaluated", "unexpected"))
    return Row(**(parts[0].asDict() | {"evaluated": evaluated, "unexpected": unexpected, "success": unexpected == 0}))


def run_unique_checks(
    tables: Mapping[str, DataFrame], spec: list[tuple[str, str, str]], found: Mapping[tuple, Row] | None = None
) -> DataFrame:
    """All uniqueness checks; those with a result row in ``found`` are not run again."""
    found = {} if found is None else found
    frames = []
    for suite, t, c in spec:
        known = found.get((suite, t, c))
        if known is None:
            frames.append(unique_check(suite, t, tables[t], c))
        else:
            frames.append(tables[t].sparkSession.createDataFrame([tuple(known)], RESULT_SCHEMA))
    return reduce(DataFrame.unionByName, frames)


def run_checks(
    tables: Mapping[str, DataFrame], checks: list[RowCheck], unique_spec: list[tuple[str, str, str]] = (),
    counted: Mapping[str, Counted] | None = None, found: Mapping[tuple, Row] | None = None,
) -> DataFrame:
    """Row checks and uniqueness checks.

    The row checks of a table are counters of the write that made it, or of one scan: each
    task sends one row. A uniqueness check shuffles its key and a partial count, nothing else;
    carrying the counters through that shuffle would make it many times as wide, since a nearly unique
    key leaves nothing to combine on the map side.
    """
    done = run_row_checks(tables, checks, counted)
    return done.unionByName(run_unique_checks(tables, unique_spec, found)) if unique_spec else done


def gate_checks() -> list[RowCheck]:
    """Every declared check that is decided row by row."""
    return schema_not_null_checks() + schema_accepted_checks() + claims_suite_checks() + singular_checks()


def singular_checks() -> list[RowCheck]:
    """The single-table "must return no rows" tests as row predicates (a row that the
    test query would return is an unexpected row)."""
    s = SCHEMA_TESTS
    lr, premium = F.col("loss_ratio"), F.col("earned_premium_eur")
    enriched_premium = F.col("annual_premium_eur")
    return [
        RowCheck(s, "mart_loss_ratio", "", "singular:no_negative_premium", premium < 0),
        RowCheck(
            s,
            "mart_loss_ratio",
            "",
            "singular:loss_ratio_within_bounds",
            (lr > LR_SANITY_BOUND) & (premium > LR_SANITY_MIN_PREMIUM),
        ),
        RowCheck(
            s,
            "int_claims_enriched",
            "",
            "singular:loss_ratio_positive",
            enriched_premium.isNotNull() & (enriched_premium > 0) & lr.isNotNull() & (lr < 0),
        ),
    ]


def column_set_check(table: str, df: DataFrame, expected: list[str], exact: bool = True) -> dict:
    """Column-set containment of a table's schema (metadata only, no data read):
    the expected columns that are missing and, with ``exact``, the unexpected ones."""
    have = set(df.columns)
    missing = sorted(set(expected) - have)
    extra = sorted(have - set(expected)) if exact else []
    return {"table_name": table, "missing": missing, "unexpected": extra, "success": not missing and not extra}


# ---- the declared suites -------------------------------------------------------------


def schema_not_null_checks() -> list[RowCheck]:
    return [not_null(SCHEMA_TESTS, t, c) for t, cols in NOT_NULL.items() for c in cols]


def schema_accepted_checks() -> list[RowCheck]:
    return [in_set(SCHEMA_TESTS, t, c, v) for (t, c), v in ACCEPTED.items()]


def schema_unique_spec() -> list[tuple[str, str, str]]:
    return [(SCHEMA_TESTS, t, c) for t, cols in UNIQUE.items() for c in cols]


def claims_suite_checks() -> list[RowCheck]:
    """The expectation suite, on the raw claims table."""
    t = "raw_claims"
    return [
        not_null(CLAIMS_SUITE, t, "claim_id"),
        not_null(CLAIMS_SUITE, t, "policy_id"),
        in_set(CLAIMS_SUITE, t, "lob", LINES_OF_BUSINESS),
        in_set(CLAIMS_SUITE, t, "status", CLAIM_STATUSES),
        between(CLAIMS_SUITE, t, "ultimate_cost", min_value=0, strict_min=True),
        between(CLAIMS_SUITE, t, "paid_amount", min_value=0),
        between(CLAIMS_SUITE, t, "reserve", min_value=0),
        pair_greater(CLAIMS_SUITE, t, "reporting_date", "claim_date", or_equal=True),
    ]


def claims_suite_unique_spec() -> list[tuple[str, str, str]]:
    return [(CLAIMS_SUITE, "raw_claims", "claim_id")]


def gate_unique_spec() -> list[tuple[str, str, str]]:
    """Every declared uniqueness check."""
    return schema_unique_spec() + claims_suite_unique_spec()


# ---- singular tests: the query returns the failing rows ------------------------------


def no_negative_premium(mart_loss_ratio: DataFrame) -> DataFrame:
    return mart_loss_ratio.where(F.col("earned_premium_eur") < 0).select(
        "line_of_business", "region", "accident_year", "earned_premium_eur"
    )


def loss_ratio_within_bounds(mart_loss_ratio: DataFrame) -> DataFrame:
    """Segments above 500 % with more than 10,000 of premium (sanity bound)."""
    return mart_loss_ratio.where(
        (F.col("loss_ratio") > LR_SANITY_BOUND) & (F.col("earned_premium_eur") > LR_SANITY_MIN_PREMIUM)
    ).select("line_of_business", "region", "accident_year", "loss_ratio")


def loss_ratio_positive(enriched: DataFrame) -> DataFrame:
    return enriched.where(
        F.col("annual_premium_eur").isNotNull()
        & (F.col("annual_premium_eur") > 0)
        & F.col("loss_ratio").isNotNull()
        & (F.col("loss_ratio") < 0)
    ).select(
        "claim_id",
        "policy_id",
        "line_of_business",
        "region",
        "accident_year",
        "ultimate_cost_eur",
        "annual_premium_eur",
        "loss_ratio",
    )


def claim_count_consistency(mart_loss_ratio: DataFrame, stg_claims: DataFrame) -> DataFrame:
    """One row (mart total, staging total) when the two claim counts differ."""
    mart_total = mart_loss_ratio.agg(F.sum("claim_count").cast("bigint").alias("mart_claims"))
    staged = stg_claims.select(F.count(F.lit(1)).alias("n")).scalar()
    return mart_total.select(
        "mart_claims", staged.cast("bigint").alias("staging_claims")
    ).where(F.col("mart_claims") != F.col("staging_claims"))


def orphan_claims(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims whose policy_id has no policy (referential integrity). The anti join reads
    both shuffles directly, so adaptive execution can split a hot policy's claims."""
    return claims.join(policies.select("policy_id"), "policy_id", "left_anti").select(
        "claim_id", "policy_id"
    )


def null_rates(table: str, df: DataFrame) -> DataFrame:
    """Share of NULLs in every column, one aggregation pass."""
    cols = df.columns
    agg = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.col("_rows").alias("rows"),
                F.col(f"_n{i}").alias("nulls"),
            )
            for i, c in enumerate(cols)
        ]
    )
    out = agg.select(F.inline(rows))
    return out.withColumn(
        "null_rate", F.when(F.col("rows") > 0, F.col("nulls").cast("double") / F.col("rows").cast("double"))
    )


def invariant_checks() -> list[RowCheck]:
    """Range and date invariants of the raw layer (positive premium, 18 <= age < 75,
    expiry after inception, positive cost)."""
    s = "raw_invariants"
    age = F.col("insured_age")
    return [
        RowCheck(s, "raw_policies", "annual_premium", "positive", ~(F.col("annual_premium") > 0)),
        RowCheck(s, "raw_policies", "insured_age", "between_18_and_74", age.isNotNull() & ((age < 18) | (age >= 75))),
        RowCheck(
            s,
            "raw_policies",
            "expiry_date,inception_date",
            "a_greater_than_b",
            ~(F.col("expiry_date") > F.col("inception_date")),
        ),
        RowCheck(s, "raw_claims", "ultimate_cost", "positive", ~(F.col("ultimate_cost") > 0)),
    ]


def staged_cost_checks() -> list[RowCheck]:
    """The documented expression test on staged claims: costs are not negative."""
    return [between(SCHEMA_TESTS, "stg_claims", "ultimate_cost_eur", min_value=0)]


def suite_summary(results: DataFrame) -> DataFrame:
    """Per suite: success and evaluated / successful / unsuccessful expectations."""
    return results.groupBy("suite").agg(
        F.bool_and("success").alias("success"),
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
    )


def report_document(summary: DataFrame) -> DataFrame:
    """The JSON report as one row with a nested document column ``report``."""
    doc = summary.agg(
        F.bool_and("success").alias("success"),
        F.struct(
            F.sum("evaluated_expectations").alias("evaluated_expectations"),
            F.sum("successful_expectations").alias("successful_expectations"),
            F.sum("unsuccessful_expectations").alias("unsuccessful_expectations"),
        ).alias("statistics"),
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("suite").alias("expectation_suite_name"),
                    "success",
                    F.struct(
                        "evaluated_expectations", "successful_expectations", "unsuccessful_expectations"
                    ).alias("statistics"),
                )
            )
        ).alias("validation_results"),
    )
    return doc.select(F.to_json(F.struct("success", "statistics", "validation_results")).alias("report"))


def write_report(summary: DataFrame, path: str) -> None:
    """Write the report document as a single JSON file (one small row)."""
    report_document(summary).coalesce(1).write.mode("overwrite").text(path)
