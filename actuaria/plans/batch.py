"""The batch pipeline: raw -> staging -> intermediate -> marts -> quality gate.

Each layer is written once, as Parquet, under a run folder inside the shared
checkpoint folder (``spark.checkpoint.dir``) and read back by its consumers: the
lineage is cut at every layer, a layer read by three models is computed once, and a
lost executor costs a stage retry, not a rebuild of the whole chain. Marts are full
rebuilds, as a daily reload; :func:`rebuild` makes each one a generation that readers see only
when it is whole.
"""

from __future__ import annotations

import json
import sys
import uuid

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actuaria.operators import intermediate, marts, quality, segments, staging
from actuaria.plans.registry import Layers, all_quality_results
from actuaria.session import scratch_path, shuffles_removed
from actuaria.sources import loaders
from actuaria.sources.generations import LEASE_SECONDS, Generations
from actuaria.sources.loaders import write_table
from actuaria.sources.tables import RAW_CONTRACTS_SCHEMA

AUDIT_COLUMN = {
    "stg_policies": "_loaded_at",
    "stg_claims": "_loaded_at",
    "mart_loss_ratio": "_refreshed_at",
    "mart_claims_frequency": "_refreshed_at",
    "mart_portfolio_performance": "_refreshed_at",
    "int_portfolio_summary": "_refreshed_at",
}


# Mergeable segment states: every mart of a run rolls up from them.
STATES = frozenset({"seg_policies", "seg_claims"})
# Layers written by a run: staging and the enriched claims (large, each read by several
# models), the segment states, the portfolio segments (read twice by their mart) and the marts and summary
# (tables in the reference). The raw layer is already stored upstream.
STORED = STATES | frozenset({
    "stg_policies",
    "stg_claims",
    "int_claims_enriched",
    "int_portfolio",
    "int_portfolio_summary",
    "mart_loss_ratio",
    "mart_claims_frequency",
    "mart_portfolio_performance",
})
COST = "ultimate_cost_eur"
# Marts stored by year (their readers filter on it) and sorted by line and region within
CLUSTERED = {
    "mart_loss_ratio": "accident_year",
    "mart_claims_frequency": "accident_year",
    "mart_portfolio_performance": "inception_year",
    "int_portfolio_summary": "accident_year",
}
BROADCAST_POLICIES = 1_000_000  # policies of very frequent ids that a join may broadcast
ROUND_BYTES = 64 * 1024**2  # stored bytes of a layer shuffled in one round, until there are so many rounds
ROUNDS = 4
# Staging tables written bucketed by the join key of the enrichment (claims ⋈ policies)
BUCKETED = {"stg_policies": "policy_id", "stg_claims": "policy_id"}
# For a quality run alone: every layer that is checked, so that its write carries the checks.
SHARED_FOR_CHECKS = STORED - {"int_portfolio_summary"}


def _of_round(df: DataFrame, key: str, rounds: int, k: int) -> DataFrame:
    """The rows whose ``key`` (NULL too) falls into round ``k``."""
    return df if rounds == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(rounds)) == k)


class StoredLayers(Layers):
    """Layers that are written on first use and read back from the run folder.

    The write of a layer carries the counters of its row checks (``counted``), so the quality
    gate reads no layer again for them. The counters stand in the stage that writes, whose tasks
    count once however often they are tried; only the raw claims are counted on their way into
    the staged claims, in that same stage (staging is row by row, without a shuffle).
    """

    materialized = True

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        root: str | None = None,
        audit: bool = False,
        stored: frozenset[str] | set[str] | None = None,
        buckets: int | None = None,
        bucketed: bool = False,
    ):
        super().__init__(spark, sf_dir)
        self.run_id = uuid.uuid4().hex[:12]
        self.root = root or scratch_path(spark, f"batch-{self.run_id}")
        self.audit = audit
        self.stored = STORED if stored is None else frozenset(stored)
        # Opt-in: staging tables bucketed by policy_id make the enrichment join
        # shuffle-free. It costs one more write of both, which pays for runs that join them
        # several times. Very frequent policies are kept out of the buckets (see _write_bucketed).
        # Bucket count: the session's shuffle partition count.
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables_created: list[str] = []
        self.bucketed = bucketed
        self.counted: dict[str, quality.Counted] = {}
        self.unique_found: dict[tuple[str, str, str], Row] = {}
        self.layout: dict[str, tuple[DataFrame, DataFrame | None]] = {}  # (bucketed rows, rows kept apart)

    # Layers in the order of their needs: those of one line need only lines above.
    STEPS = (
        ("stg_policies", "stg_claims"),
        ("enriched", "seg_policies"),
        ("seg_claims", "portfolio"),
        ("mart_loss_ratio", "mart_claims_frequency", "mart_portfolio_performance", "portfolio_summary"),
    )

    def build(self, at_once: int = 4, unique: Sequence[tuple[str, str, str]] = ()) -> StoredLayers:
        """Write every stored layer, those that do not need each other at the same time.

        The long tail of one write then leaves no executor idle. The bucketed layout is built
        one after the other, as its policies follow its claims. The uniqueness checks ``unique``
        (suite, table, column) run one at a time beside the writes of later layers, each when its table is
        there; ``unique_found`` has their result rows. A table that is not stored is checked before the first
        write: its check makes the largest shuffles of all (the raw claims' join and their ids). Shuffle files are
        removed after each write and check, so disk is what is stored and the shuffles of that moment.
        """
        tables = {attribute: name for name, attribute in Layers.TABLE_ATTRIBUTES.items()}
        tables["portfolio_summary"] = "int_portfolio_summary"
        write = inheritable_thread_target(self.spark)(lambda name: getattr(self, name))
        check = inheritable_thread_target(self.spark)(self._unique)
        later = {tables[name] for step in self.STEPS for name in step} & self.stored
        with shuffles_removed(self.spark), ThreadPoolExecutor(max_workers=1) as checking:
            running = {u: checking.submit(check, *u) for u in unique if u[1] not in later}
            for future in running.values():
                future.result()
            for step in self.STEPS:
                names = [name for name in step if tables[name] in self.stored]
                with ThreadPoolExecutor(max_workers=1 if self.bucketed else at_once) as pool:
                    for future in [pool.submit(write, name) for name in names]:
                        future.result()
                later -= {tables[name] for name in names}
                ready = [u for u in unique if u[1] not in later and u not in running]
                running |= {u: checking.submit(check, *u) for u in ready}
            self.unique_found = {u: future.result() for u, future in running.items()}
        return self

    def _unique(self, suite: str, table: str, column: str) -> Row:
        """The result row of a uniqueness check, by rounds (half of those of a join: an id is far narrower than its row)."""
        df = self.tables()[table]
        rounds = -(-self.rounds([table], [df], column) // 2)
        return quality.added_up([
            quality.unique_check(suite, table, _of_round(df, column, rounds, k), column).first() for k in range(rounds)
        ])

    def rounds(self, names: Sequence[str], layers: Sequence[DataFrame], key: str) -> int:
        """In how many rounds the rows of the stored layers ``names`` are shuffled by ``key``.

        Each round takes the keys of one range of hash values, reads the first layer again and shuffles its
        share of the rows; a round's shuffle is gone before the next begins. There are no more than
        ``ROUNDS``, as each is one more scan. Layers that are not stored would be computed again; and only
        texts are split, whose equal values surely have equal hashes.
        """
        kinds = {df.schema[key].dataType for df in layers}
        if kinds != {T.StringType()} or not self.stored >= set(names):
            return 1
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(names[0]))
        stored = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
        return max(1, min(ROUNDS, -(-stored // ROUND_BYTES)))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _keep(self, name: str, df: DataFrame, *more: DataFrame) -> DataFrame:
        """``df`` as a stored layer, or ``df`` and the ``more`` parts that follow it, written one after the other."""
        if name not in self.stored:
            return df
        parts = [df, *more]
        if self.audit and name in AUDIT_COLUMN:
            parts = [part.withColumn(AUDIT_COLUMN[name], F.current_timestamp()) for part in parts]
        stored = self._write(name, *parts)
        if name in BUCKETED and self.bucketed:
            stored = self._write_bucketed(name, stored, BUCKETED[name])
        return stored.drop(AUDIT_COLUMN[name]) if name in AUDIT_COLUMN and self.audit else stored

    def _write(self, name: str, df: DataFrame, *more: DataFrame) -> DataFrame:
        """Write ``df`` (and ``more`` parts) at ``path(name)`` with the counters of its checks; read it back."""
        year = CLUSTERED.get(name)
        seen = []
        for part in (df, *more):
            placed = part if year is None else loaders.clustered(part, year, ["line_of_business", "region"])
            counted, counters = self._with_counters(name, placed)
            write_table(counted, self.path(name), [year] if year else None, "append" if seen else "overwrite")
            seen.append(counters)
        self.counted[name] = quality.Counted.together(seen)
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(*df.columns)

    def _with_counters(self, name: str, df: DataFrame) -> tuple[DataFrame, quality.Counted]:
        more = {
            "int_claims_enriched": [F.min(COST).alias("_least"), F.max(COST).alias("_most")],
            "seg_claims": [F.sum("claim_count").alias("_claims")],
        }
        return quality.Counted.on(df, [ch for ch in quality.gate_checks() if ch.table == name], *more.get(name, []))

    @cached_property
    def stg_claims(self) -> DataFrame:
        if "stg_claims" not in self.stored:
            return Layers.stg_claims.func(self)
        raw, counted = self._with_counters("raw_claims", self.raw_claims)
        stored = self._keep("stg_claims", staging.stg_claims(raw))
        self.counted["raw_claims"] = counted
        return stored

    @cached_property
    def seg_policies(self) -> DataFrame | None:
        if "seg_policies" not in self.stored:
            return None
        return self._keep("seg_policies", segments.policies_state(self.stg_policies))

    @cached_property
    def seg_claims(self) -> DataFrame | None:
        if "seg_claims" not in self.stored:
            return None
        return self._keep("seg_claims", segments.claims_state(self.enriched))

    def _loss_ratio(self) -> DataFrame:
        """From the states, unless a policy id held by several policies repeats claims in the
        enriched layer: the write of the claims' state added up the enriched claims (every staged
        claim has an id), that of the staged claims counted those."""
        if self.seg_claims is not None and self.seg_policies is not None:
            enriched = self.counted["seg_claims"].seen.get["_claims"] or 0
            if self.rows_written().get("stg_claims") == enriched:
                return marts.loss_ratio_of(self.seg_policies, self.seg_claims)
        return super()._loss_ratio()

    @property
    def cost_bounds(self) -> tuple | None:
        """Least and greatest cost of the enriched claims, from their write."""
        if "int_claims_enriched" not in self.counted:
            return None
        seen = self.counted["int_claims_enriched"].seen.get
        return seen["_least"], seen["_most"]

    def _write_bucketed(self, name: str, staged: DataFrame, key: str) -> DataFrame:
        """A copy of the stored layer ``staged``, bucketed and sorted by ``key``.

        The shuffle by ``key`` happens once, in this write; later joins and
        aggregations on ``key`` between tables with the same bucket count read the
        buckets in place (no exchange).

        A bucket holds all rows of its keys. So the rows of very frequent policies, those with
        more claims than half a bucket should hold (at most twice as many as there are buckets),
        are written apart, unbucketed, and joined with the few policies of these ids by
        broadcast. Staging leaves no row without a key.
        """
        apart = None
        hot = self.hot_policies(staged if name == "stg_claims" else None)
        if hot is not None:
            left = staged.join(F.broadcast(hot), key, "left_anti")
            apart = self._write(f"{name}_apart", staged.join(F.broadcast(hot), key, "left_semi"))
        else:
            left = staged
        table = f"`{name}_{self.run_id}`"
        (
            left.repartition(self.buckets, key).write.mode("overwrite")
            .bucketBy(self.buckets, key)
            .sortBy(key)
            .option("path", self.path(f"{name}_bucketed"))
            .saveAsTable(table)
        )
        self.tables_created.append(table)
        bucketed = self.spark.table(table)
        self.layout[name] = bucketed, apart
        return bucketed if apart is None else staged

    def hot_policies(self, claims: DataFrame | None = None) -> DataFrame | None:
        """Ids with too many staged claims for a bucket; None where there are none.

        Counted exactly, combined on the map side. ``claims`` are the staged claims where they
        are just being written; else they are built first.
        """
        if claims is not None:
            key = BUCKETED["stg_claims"]
            limit = self.counted["stg_claims"].rows() / (2 * self.buckets)
            counts = claims.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            self.hot = self._write("hot_policies", counts.where(F.col("n") > limit).select(key))
        else:
            _ = self.stg_claims
        return self.hot if self.counted["hot_policies"].rows() else None

    def joined_by_bucket(self) -> DataFrame:
        """The enriched claims of the bucketed layout, without a shuffle."""
        _ = self.stg_claims, self.stg_policies
        (claims, hot_claims), (policies, hot_policies) = self.layout["stg_claims"], self.layout["stg_policies"]
        joined = intermediate.claims_enriched(claims, policies)
        if hot_claims is None:
            return joined
        if self.counted["stg_policies_apart"].rows() <= BROADCAST_POLICIES:
            hot_policies = F.broadcast(hot_policies)
        return joined.unionByName(intermediate.claims_enriched(hot_claims, hot_policies))

    @cached_property
    def enriched(self) -> DataFrame:
        """The bucketed layout is joined at once, without a shuffle; else the join that is stored runs by
        rounds of policies, as its shuffle of whole claims is larger than any layer."""
        if self.bucketed and self.stored >= set(BUCKETED):
            return self._keep("int_claims_enriched", self.joined_by_bucket())
        if "int_claims_enriched" not in self.stored:
            return Layers.enriched.func(self)
        claims, policies = self.stg_claims, self.stg_policies
        rounds = self.rounds(["stg_claims", "stg_policies"], [claims, policies], "policy_id")
        return self._keep("int_claims_enriched", *(
            intermediate.claims_enriched(*(_of_round(df, "policy_id", rounds, k) for df in (claims, policies)))
            for k in range(rounds)
        ))

    def rows_written(self) -> dict[str, int]:
        """Rows of every layer written so far, as its write counted them."""
        return {name: c.rows() for name, c in self.counted.items() if name in self.stored}

    def drop_catalog_entries(self) -> None:
        """Forget this run's bucketed tables in the catalog; their files stay in the
        run folder (external tables), so stored layers remain readable by path."""
        for table in self.tables_created:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables_created.clear()


class FileLayers(Layers):
    """Layers whose raw tables are Parquet files ``<raw_dir>/{policies,claims,contracts}.parquet``
    (the loaders' input) instead of the driver tables.

    Types are taken from the files, as the loaders do (dates may arrive as
    timestamps, amounts as doubles); the staging casts normalise them. A missing
    treaty file means no treaties.
    """

    def _raw(self, name: str, required: bool = True) -> DataFrame | None:
        """One raw file; None only when an optional one does not exist."""
        path = f"{self.sf_dir.rstrip('/')}/{name}.parquet"
        try:
            return loaders.read_raw_parquet(self.spark, path)
        except AnalysisException as exc:
            if not loaders.missing_path(exc):
                raise
            if required:
                raise FileNotFoundError(f"raw file {path} does not exist") from exc
            return None

    @cached_property
    def raw_policies(self) -> DataFrame:
        return self._keep("raw_policies", self._raw("policies"))

    @cached_property
    def raw_claims(self) -> DataFrame:
        return self._keep("raw_claims", self._raw("claims"))

    @cached_property
    def raw_contracts(self) -> DataFrame:
        found = self._raw("contracts", required=False)
        return found if found is not None else self.spark.createDataFrame([], RAW_CONTRACTS_SCHEMA)


class StoredFileLayers(StoredLayers, FileLayers):
    """File-backed raw layer with stored staging, enriched claims and marts."""


def run_batch(
    spark: SparkSession,
    sf_dir: str,
    root: str | None = None,
    audit: bool = True,
    fail_on_error: bool = False,
    source: str = "tables",
) -> dict:
    """Build every layer and mart, run the quality gate, write its JSON report.

    ``source`` is "tables" (the raw layer derived from the driver tables in ``sf_dir``)
    or "files" (raw Parquet files in ``sf_dir``, see :class:`FileLayers`).

    Returns ``{"root": run folder, "quality": [per-suite rows as dicts], "error": None}``.
    If building or checking raises, a failure report ``{"success": false, "error": ...}``
    is written in place of the normal one (so the report always exists) and the result
    carries the error. With ``fail_on_error`` a failing suite or an error raises (the
    non-zero exit of the gate).
    """
    layers_class = StoredFileLayers if source == "files" else StoredLayers
    layers = layers_class(spark, sf_dir, root, audit=audit)
    report_path = layers.path("data_quality_report")
    try:
        layers.build(unique=quality.gate_unique_spec())
        summary = quality.suite_summary(all_quality_results(layers))
        quality.write_report(summary, report_path)
        rows = [r.asDict() for r in summary.collect()]  # one row per suite
    except Exception as exc:  # the gate must still leave a report behind
        failure = json.dumps({"success": False, "error": str(exc).splitlines()[0][:2000]})
        spark.createDataFrame([(failure,)], "report string").coalesce(1).write.mode("overwrite").text(
            report_path
        )
        if fail_on_error:
            raise
        return {"root": layers.root, "quality": None, "error": str(exc).splitlines()[0], "rows": {}}
    layers.drop_catalog_entries()
    if fail_on_error and not all(r["success"] for r in rows):
        raise RuntimeError(f"data quality gate failed: {rows}")
    return {"root": layers.root, "quality": rows, "error": None, "rows": layers.rows_written()}


def rebuild(
    spark: SparkSession, sf_dir: str, home: str, source: str = "tables", require_quality: bool = False,
    lease_seconds: int = LEASE_SECONDS,
) -> dict:
    """A batch run as a new generation of ``home``, current only when all of it is written.

    Readers (:meth:`Generations.reading`) see the generation before until then, and go on reading
    it afterwards; it is removed when no reader is left. A run that raises, or with
    ``require_quality`` one whose suites fail, never becomes current: its folder (with the report) stays until
    the next rebuild clears it away. Returns the result of the run and its ``generation``
    (None where it was not published).
    """
    generations = Generations(spark, home, lease_seconds)
    new = generations.begin()
    result = run_batch(spark, sf_dir, generations.folder(new), source=source)
    passed = result["error"] is None and (not require_quality or all(r["success"] for r in result["quality"]))
    if passed:
        generations.publish(new, result["rows"])
        generations.retire()
    else:
        generations.give_up(new)
    return {**result, "generation": new if passed else None}


def presentation(df: DataFrame, name: str) -> DataFrame:
    """The mart's stored order, applied only when it is presented (not on write)."""
    order = {
        "mart_loss_ratio": marts.loss_ratio_order,
        "mart_claims_frequency": marts.frequency_order,
        "mart_portfolio_performance": marts.performance_order,
    }[name]
    return df.orderBy(*order())


if __name__ == "__main__":
    # spark-submit actuaria/plans/batch.py <tables|files> <input folder> [<run folder>]
    # (the session, its checkpoint folder and sizing come from spark-submit's conf)
    from actuaria.session import build_session

    session = build_session(app_name="actuaria-batch")
    source, folder = sys.argv[1], sys.argv[2]
    run_root = sys.argv[3] if len(sys.argv) > 3 else None
    result = run_batch(session, folder, run_root, fail_on_error=True, source=source)
    print(json.dumps({"root": result["root"], "quality": result["quality"]}, default=str))
