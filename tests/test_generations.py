"""Rebuilds that die, readers that stay, and loads that switch in one step."""

import pytest
from pyspark.sql import functions as F

from actuaria.plans.batch import rebuild
from actuaria.sources import loaders
from actuaria.sources.generations import Generations, IncompleteGeneration
from tests.conftest import SF_SMALL


def numbers(spark, n):
    return spark.range(n).withColumn("v", F.col("id") * 2)


def broken(spark, n):
    """Some tasks write their rows, one fails."""
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("killed in the middle"))).otherwise(F.col("v"))
    return numbers(spark, n).repartition(4, "id").withColumn("v", bad)


def test_a_rebuild_that_dies_leaves_the_old_tables(spark, tmp_path):
    home = Generations(spark, str(tmp_path / "home"))
    assert home.replace({"a": numbers(spark, 10), "b": numbers(spark, 3)}) == {"a": 10, "b": 3}
    with pytest.raises(Exception, match="killed in the middle"):
        home.replace({"a": numbers(spark, 50), "b": broken(spark, 400)})
    unfinished = home.begin()  # a process that ended without a word after one table
    numbers(spark, 70).write.parquet(f"{home.folder(unfinished)}/a")
    with home.reading() as now:
        assert now.table("a").count() == 10 and now.table("b").count() == 3
    with pytest.raises(IncompleteGeneration):
        home.publish(unfinished, {"a": 70, "b": 1})
    with pytest.raises(IncompleteGeneration):
        home.publish(unfinished, {"a": 71})
    with home.reading() as now:
        assert now.table("a").count() == 10
    # the next rebuild clears up, but for the one whose writer may still be alive
    home.replace({"a": numbers(spark, 20), "b": numbers(spark, 4)})
    assert set(home._names("generations")) == {home.current(), unfinished}
    Generations(spark, home.home, lease_seconds=0).retire()
    assert set(home._names("generations")) == {home.current()} and not home._names("writers")


def test_two_rebuilds_leave_one_and_a_reader_keeps_its_own(spark, tmp_path):
    home = Generations(spark, str(tmp_path / "home"))
    with pytest.raises(FileNotFoundError):
        with home.reading():
            pass
    home.replace({"a": numbers(spark, 10)})
    with home.reading() as before:
        home.replace({"a": numbers(spark, 20)})
        assert before.table("a").count() == 10  # still whole after the switch
        with home.reading() as now:
            assert now.table("a").count() == 20
        assert len(home._names("generations")) == 2
    home.replace({"a": numbers(spark, 30)})
    assert set(home._names("generations")) == {home.current()} and len(home._names("current")) == 1


def test_a_reader_that_comes_too_late_takes_the_newer_generation(spark, tmp_path, monkeypatch):
    home = Generations(spark, str(tmp_path / "home"))
    home.replace({"a": numbers(spark, 10)})
    mark, raced = home._mark, []

    def slow_mark(*name):  # a rebuild ends between the look at the marker and the lease
        if name[0] == "readers" and not raced:
            raced.append(name)
            Generations(spark, home.home).replace({"a": numbers(spark, 20)})
        mark(*name)

    monkeypatch.setattr(home, "_mark", slow_mark)
    with home.reading() as now:
        assert raced and now.table("a").count() == 20


def test_an_empty_table_and_two_writers_at_once(spark, tmp_path):
    home = Generations(spark, str(tmp_path / "home"))
    assert home.replace({"a": numbers(spark, 0)}) == {"a": 0}
    one, two = home.begin(), home.begin()
    for new, n in ((one, 5), (two, 6)):
        numbers(spark, n).write.parquet(f"{home.folder(new)}/a")
    home.publish(two, {"a": 6})
    home.publish(one, {"a": 5})
    home.retire()
    with home.reading() as now:
        assert now.id == one and now.table("a").count() == 5


def test_a_load_that_dies_leaves_the_table(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    numbers(spark, 12).write.parquet(good)
    assert loaders.load_parquet(spark, good, "swapped_t") == 12
    resolved = spark.table("raw.swapped_t")  # a query planned before the next load
    with pytest.raises(Exception, match="killed in the middle"):
        loaders._load(spark, broken(spark, 400), "swapped_t", "raw")
    assert spark.table("raw.swapped_t").count() == 12
    numbers(spark, 5).withColumn("w", F.lit("new column")).write.parquet(bad)
    assert loaders.load_parquet(spark, bad, "swapped_t") == 5
    assert spark.table("raw.swapped_t").columns == ["id", "v", "w"] and resolved.count() == 12
    loaders.drop(spark, "swapped_t")
    assert not spark.catalog.tableExists("raw.swapped_t")


def test_a_plain_table_of_that_name_is_replaced(spark, tmp_path):
    loaders.ensure_database(spark, "raw")
    numbers(spark, 3).write.mode("overwrite").saveAsTable("raw.plain_t")
    numbers(spark, 8).write.parquet(str(tmp_path / "p"))
    assert loaders.load_parquet(spark, str(tmp_path / "p"), "plain_t") == 8
    assert spark.table("raw.plain_t").count() == 8
    loaders.drop(spark, "plain_t")


def test_one_failing_load_leaves_the_others_whole(spark, tmp_path):
    for name, n in (("policies", 5), ("contracts", 2)):
        numbers(spark, n).write.parquet(str(tmp_path / f"{name}.parquet"))
    (tmp_path / "claims.parquet").write_bytes(b"not parquet")
    with pytest.raises(loaders.LoadError) as caught:
        loaders.load_all_raw(spark, str(tmp_path), database="raw_partial_t")
    assert caught.value.loaded == {"policies": 5, "contracts": 2} and list(caught.value.failed) == ["claims"]
    assert spark.table("raw_partial_t.policies").count() == 5


def test_loads_run_beside_each_other(spark, tmp_path):
    """Both loads wait until the other one has started: one after the other they would never end."""
    import threading

    both = threading.Barrier(2, timeout=60)
    load = loaders._load

    def meet(*args):
        both.wait()
        return load(*args)

    for name in ("policies", "claims"):
        numbers(spark, 4).write.parquet(str(tmp_path / f"{name}.parquet"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(loaders, "_load", meet)
        assert loaders.load_all_raw(spark, str(tmp_path), database="raw_beside_t") == {"policies": 4, "claims": 4}


def test_rebuild_publishes_a_whole_run_only(spark, tmp_path):
    home = str(tmp_path / "home")
    first = rebuild(spark, SF_SMALL, home)
    assert first["generation"] == Generations(spark, home).current()
    assert first["rows"]["mart_loss_ratio"] == 158 and {"stg_claims", "seg_claims", "int_portfolio"} <= set(first["rows"])
    failed = rebuild(spark, str(tmp_path / "no-such-folder"), home)
    strict = rebuild(spark, SF_SMALL, home, require_quality=True)  # dirty rows on purpose
    assert failed["generation"] is None and strict["generation"] is None
    with Generations(spark, home).reading() as now:
        assert now.id == first["generation"] and now.table("mart_loss_ratio").count() == 158
