import datetime as dt
from decimal import Decimal as D

from actuaria.operators.staging import stg_contracts
from actuaria.session import ensure_checkpoint_dir, materialize
from actuaria.sources.rawlayer import raw_contracts


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = ensure_checkpoint_dir(spark).replace("file:", "")
    if configured:  # named by the session: used as is
        assert current.startswith(configured.rstrip("/"))
    else:  # unset (local tests only): a temporary folder
        assert "actuaria-ckpt-" in current


def test_materialize_writes_under_the_checkpoint_folder(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    out = materialize(df, "unit")
    assert sorted(r.x for r in out.collect()) == list(range(10))
    paths = out.inputFiles()
    assert paths and all(ensure_checkpoint_dir(spark).replace("file:", "") in p.replace("file:", "") for p in paths)


def test_stg_contracts_types_and_dates(spark):
    rows = {r.contract_id: r for r in stg_contracts(raw_contracts(spark)).collect()}
    assert set(rows) == {"XL-AUTO-2023", "XL-HOME-2023", "QUOTA-LIAB-2023"}
    auto, quota = rows["XL-AUTO-2023"], rows["QUOTA-LIAB-2023"]
    assert auto.line_of_business == "auto" and auto.retention == D("100000.00") and auto.treaty_limit == D("500000.00")
    assert auto.premium_rate == D("0.045000") and auto.effective_date == dt.date(1995, 1, 1)
    assert auto.treaty_duration_days == 1460
    assert quota.retention == D("0.70") and quota.treaty_limit is None and quota.reinstatements is None


def test_scale_settings_size_partitions():
    from actuaria.session import scale_settings

    conf = scale_settings(18 * 1024**4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 18 * 1024**4 // (256 * 1024**2)
    assert conf["spark.sql.files.maxPartitionBytes"] == "256m"
    assert scale_settings(10)["spark.sql.shuffle.partitions"] == "200"


def test_write_accidents_partitioned_by_year(spark, tmp_path):
    from actuaria.operators.accidents import enrich_accidents, write_accidents

    header = spark.createDataFrame(
        [(1, 2021, 1, 1, "00:00", "75", 1, 1), (2, 2022, 1, 1, "00:00", "75", 1, 1)],
        "Num_Acc long, an int, mois int, jour int, hrmn string, dep string, atm int, lum int",
    )
    path = str(tmp_path / "acc")
    write_accidents(enrich_accidents(header), path)
    assert sorted(p.name for p in (tmp_path / "acc").iterdir() if p.name.startswith("annee=")) == ["annee=2021", "annee=2022"]
    assert spark.read.parquet(path).where("annee = 2022").count() == 1


def test_old_scratch_tables_are_cleared(spark):
    import os

    from actuaria.session import clear_scratch, materialize

    old, new = materialize(spark.range(3), "clear-old"), materialize(spark.range(4), "clear-new")
    folder = os.path.dirname(old.inputFiles()[0].removeprefix("file://"))
    os.utime(folder, (0, 0))
    gone = clear_scratch(spark, 3600)
    assert [g for g in gone if g.startswith("clear-")] == [os.path.basename(folder)]
    assert not os.path.exists(folder) and new.count() == 4


def test_the_sessions_own_shuffle_setting_comes_back_after_the_last_block(spark):
    from actuaria.session import SHUFFLE_CLEANUP, shuffles_removed

    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    first, second = shuffles_removed(spark), shuffles_removed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "true"  # the second is still open
    second.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
