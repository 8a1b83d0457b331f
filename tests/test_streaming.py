"""Incremental staging: each landed file is staged exactly once across runs."""

import datetime as dt
from decimal import Decimal as D

from actuaria.sources.tables import RAW_CLAIMS_SCHEMA
from actuaria.streaming import stage_incrementally


def batch(spark, ids):
    day = dt.date(2023, 1, 1)
    rows = [(i, "P1", "Auto", "R", day, day + dt.timedelta(days=40), D("10.00"), D("1.00"), D("1.00"), "open", "Theft") for i in ids]
    return spark.createDataFrame(rows, RAW_CLAIMS_SCHEMA)


def test_second_run_only_adds_new_files(spark, tmp_path):
    landing, sink, ckpt = (str(tmp_path / p) for p in ("landing", "staged", "ckpt"))
    batch(spark, ["C1", "C2", None]).write.mode("append").parquet(landing)
    first = stage_incrementally(spark, "claims", landing, sink, ckpt)
    assert sorted(r.claim_id for r in first.collect()) == ["C1", "C2"]
    batch(spark, ["C3"]).write.mode("append").parquet(landing)
    second = stage_incrementally(spark, "claims", landing, sink, ckpt)
    rows = second.collect()
    assert sorted(r.claim_id for r in rows) == ["C1", "C2", "C3"]
    assert all(r.is_ibnr_candidate for r in rows)
