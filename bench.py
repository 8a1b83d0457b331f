"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs in full into Spark's ``noop`` sink (the whole plan executes, nothing
is collected to the driver). A short warm-up runs first so that JVM start-up is not
charged to the first query. Every query is then timed twice: ``cold_queries`` is the
first run in this JVM (includes code generation for its plan), ``queries`` the second
(steady state, as in a long-running service: the JIT is warm and the lazy layer
graph is already built; every run still executes its whole plan over the tables, and
queries that materialise an input or build stored layers write them again).
``batch_run`` is one batch run that
builds every layer once, writes the marts and runs the quality gate. ``calibration`` is
the time of two fixed pieces of work, before and after the queries: a loop of one Python process
and a Spark sum that keeps every core busy. Runs on different (or shared) hosts compare by them.
Prints one JSON line; ``value`` is the sum of the steady-state query times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from actuaria.plans.batch import run_batch  # noqa: E402
from actuaria.plans.registry import QUERIES  # noqa: E402
from actuaria.session import build_session  # noqa: E402

HEADLINE = [
    "loss_ratio",
    "claims_frequency",
    "portfolio_performance",
    "portfolio_summary",
    "claims_enriched",
    "kpi_cards",
    "quality_report",
    "accidents_enriched",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def calibrate(spark) -> dict[str, float]:
    """Seconds of work that does not depend on this library."""
    t0 = time.perf_counter()
    sum(i * i % 7 for i in range(5_000_000))
    t1 = time.perf_counter()
    spark.range(0, 400_000_000, 1, 64).selectExpr("sum(id * id % 7) as s").collect()
    return {"python": round(t1 - t0, 3), "spark": round(time.perf_counter() - t1, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="actuaria-bench-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="actuaria-bench",
        shuffle_partitions=cpus * 2,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        },
    )
    run(spark, "stg_policies", sf_dir)  # warm-up
    calibrate(spark)
    before = calibrate(spark)
    cold = {name: run(spark, name, sf_dir) for name in names}
    warm = {name: run(spark, name, sf_dir) for name in names}
    t0 = time.perf_counter()
    run_batch(spark, sf_dir)
    batch_run = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold_queries": cold,
                "cold_total": round(sum(cold.values()), 3),
                "batch_run": batch_run,
                "calibration": {"before": before, "after": calibrate(spark)},
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
