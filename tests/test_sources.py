"""Loaders (replace, not append), CSV reading and the road-accident files."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from actuaria.operators.accidents import enrich_accidents, read_accident_dir
from actuaria.sources import loaders


def test_load_parquet_creates_and_replaces(spark, tmp_path):
    path = str(tmp_path / "policies.parquet")
    pd.DataFrame({"policy_id": [f"P{i}" for i in range(100)], "x": range(100)}).to_parquet(path, index=False)
    assert loaders.load_parquet(spark, path, "policies_t") == 100
    assert loaders.load_parquet(spark, path, "policies_t") == 100  # reload replaces
    assert spark.table("raw.policies_t").count() == 100


def test_load_csv_infers_types(spark, tmp_path):
    path = tmp_path / "test.csv"
    pd.DataFrame({"a": [1, 2, 3], "b": ["x", "y", "z"]}).to_csv(path, index=False)
    assert loaders.load_csv(spark, str(path), "csv_t") == 3
    rows = spark.table("raw.csv_t").orderBy("a").collect()
    assert [r.a for r in rows] == [1, 2, 3] and [r.b for r in rows] == ["x", "y", "z"]
    assert dict(spark.table("raw.csv_t").dtypes)["a"] == "int"


def test_load_all_raw_skips_missing(spark, tmp_path):
    pd.DataFrame({"policy_id": ["P1", "P2"]}).to_parquet(tmp_path / "policies.parquet", index=False)
    counts = loaders.load_all_raw(spark, str(tmp_path), database="raw_all_t")
    assert counts == {"policies": 2}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("latin-1"))


def test_accident_csv_dir_latin1_and_missing_file(spark, tmp_path):
    root = tmp_path / "onroad"
    write(root / "2021" / "caracteristiques-2021.csv",
          "Num_Acc;an;mois;jour;hrmn;dep;com;atm;lum\n1;21;1;2;08:15;75;Père-Lachaise;1;2\n2;21;3;4;23:00;13;Marseille;2;1\n")
    write(root / "2021" / "lieux-2021.csv", "Num_Acc;catr;surf\n1;3;1\n1;4;2\n")
    write(root / "2021" / "usagers-2021.csv", "Num_Acc;grav\n1;1\n1;4\n2;2\n")
    write(root / "2022" / "Caracteristiques_2022.csv", "Num_Acc;an;mois;jour;hrmn;dep;com;atm;lum\n1;22;5;6;10:00;69;Lyon;1;1\n")
    write(root / "2022" / "vehicules_2022.csv", "Num_Acc;num_veh\n1;A01\n1;B01\n")
    out = read_accident_dir(spark, str(root))
    rows = sorted(out.collect(), key=lambda r: (r.annee, r.accident_id, r.type_voie or 0))
    assert [(r.annee, r.accident_id) for r in rows] == [(2021, 1), (2021, 1), (2021, 2), (2022, 1)]
    assert rows[0].commune == "Père-Lachaise"
    assert rows[0].gravite_max == 4 and rows[0].nb_victimes == 2  # max of codes, all users
    assert rows[2].type_voie is None and rows[2].nb_victimes == 1
    assert rows[3].nb_vehicules == 2 and rows[3].gravite_max is None  # 2022 has no usagers file
    assert rows[0].nb_vehicules is None
    assert "an" not in out.columns and "heure" in out.columns


def test_enrich_without_optional_files(spark):
    header = spark.createDataFrame([(1, 2021, 1, 1, "00:00", "75", 1, 1)], "Num_Acc long, an int, mois int, jour int, hrmn string, dep string, atm int, lum int")
    out = enrich_accidents(header)
    assert out.columns == ["accident_id", "annee", "mois", "jour", "heure", "departement", "conditions_meteo", "luminosite"]


def test_accident_years_with_different_column_layouts(spark, tmp_path):
    root = tmp_path / "layouts"
    write(root / "2019" / "caracteristiques_2019.csv", "Num_Acc;an;mois;jour;hrmn;dep;atm;lum\n7;19;1;1;01:00;75;1;1\n")
    write(root / "2020" / "caract-2020.csv", "lum;atm;dep;hrmn;jour;mois;an;Num_Acc;com\n5;9;13;02:00;2;2;20;8;Nice\n")
    out = {r.accident_id: r for r in read_accident_dir(spark, str(root)).collect()}
    assert out[7].annee == 2019 and out[7].luminosite == 1 and out[7].commune is None
    assert out[8].annee == 2020 and out[8].luminosite == 5 and out[8].conditions_meteo == 9
    assert out[8].departement == "13" and out[8].commune == "Nice"


def test_discover_assets_names_files(spark, tmp_path):
    for name in ("policies", "claims"):
        pd.DataFrame({"x": [1]}).to_parquet(tmp_path / f"{name}.parquet", index=False)
    (tmp_path / "notes.txt").write_text("ignored")
    got = {r.asset: r.bytes for r in loaders.discover_assets(spark, str(tmp_path)).collect()}
    assert set(got) == {"policies", "claims"} and all(b > 0 for b in got.values())


def test_long_keys_are_kept_whole(spark):
    from actuaria.functions.formatting import padded_key

    rows = spark.createDataFrame([(7,), (1234567890,), (1234567891,), (None,)], "n long")
    got = [r[0] for r in rows.select(padded_key("POL", "n", 9)).collect()]
    assert got == ["POL000000007", "POL1234567890", "POL1234567891", None]


def test_pandas_files_load_with_every_table(spark, tmp_path):
    import datetime as dt

    import pandas as pd

    from actuaria.sources import loaders

    last = pd.Timestamp("2023-12-31 23:59:59.999999999")
    frame = pd.DataFrame({"policy_id": ["P1", "P2"], "inception_date": [last, pd.Timestamp("1969-12-31 12:00")]})
    frame.to_parquet(tmp_path / "policies.parquet")
    pd.DataFrame({"claim_id": ["C1"]}).to_parquet(tmp_path / "claims.parquet")
    before = spark.conf.get(loaders.NANOS_AS_LONG, None)
    assert loaders.load_all_raw(spark, str(tmp_path), database="raw_pandas") == {"policies": 2, "claims": 1}
    assert loaders.load_parquet(spark, str(tmp_path / "policies.parquet"), "p", database="raw_pandas") == 2
    days = sorted(r[0] for r in spark.table("raw_pandas.p").select("inception_date").collect())
    assert days == [dt.date(1969, 12, 31), dt.date(2023, 12, 31)]
    assert spark.conf.get(loaders.NANOS_AS_LONG, None) == before
    (tmp_path / "claims.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        loaders.load_all_raw(spark, str(tmp_path), database="raw_pandas")


def test_appended_input_is_seen_by_the_next_call(spark, tmp_path):
    import shutil

    from actuaria.plans.registry import QUERIES
    from tests.conftest import SF_SMALL

    for name in ("orders", "customer", "nation", "region", "lineitem"):
        (tmp_path / f"{name}.parquet").mkdir()
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet" / "a.parquet")
    first = QUERIES["stg_policies"](spark, str(tmp_path)).count()
    shutil.copy(f"{SF_SMALL}/orders.parquet", tmp_path / "orders.parquet" / "b.parquet")
    assert QUERIES["stg_policies"](spark, str(tmp_path)).count() == 2 * first


def test_years_choose_the_folders_and_layouts_share_a_scan(spark, tmp_path):
    from actuaria.operators.accidents import accident_files_by_kind, read_accident_kind

    for year, extra in ((2019, ""), (2020, ""), (2021, ";com")):
        (tmp_path / str(year)).mkdir()
        row = f"{year}1;{year};1;2" + (";75" if extra else "")
        (tmp_path / str(year) / f"Caracteristiques-{year}.csv").write_text(f"Num_Acc;an;mois;jour{extra}\n{row}\n")
    every = read_accident_dir(spark, str(tmp_path))
    assert sorted(r.annee for r in every.collect()) == [2019, 2020, 2021]
    chosen = read_accident_dir(spark, str(tmp_path), years=[2019, 2021, 1990])
    assert sorted((r.accident_id, r.annee) for r in chosen.collect()) == [(20191, 2019), (20211, 2021)]
    assert read_accident_dir(spark, str(tmp_path), years=[1990]) is None
    files = accident_files_by_kind(spark, str(tmp_path))["caract"]
    plan = read_accident_kind(spark, files)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2  # two layouts, three folders


def test_partitioned_source_prunes_years(spark, tmp_path):
    from actuaria.operators import accidents

    header = spark.createDataFrame(
        [(y * 100 + i, y, 1, i) for y in (2018, 2019, 2020, 2021) for i in range(1, 4)], "Num_Acc long, an int, mois int, jour int"
    )
    keys = [r.Num_Acc for r in header.collect()]
    lieux = spark.createDataFrame([(k, 1, 2) for k in keys] + [(keys[0], 3, 4), (5, 9, 9)], "Num_Acc long, catr int, surf int")
    users = spark.createDataFrame([(k, 2) for k in keys[1:]], "Num_Acc long, grav int")
    files = {"caract": header, "lieux": lieux, "usag": users, "vehic": users.select("Num_Acc")}
    root = str(tmp_path / "landed")
    accidents.write_accident_source(files, root)
    whole = accidents.enrich_source(accidents.read_accident_source(spark, root))
    assert sorted((r.annee, r.accident_id, r.type_voie) for r in whole.collect()) == sorted(
        [(k // 100, k, 1) for k in keys] + [(2018, keys[0], 3)]
    )
    chosen = accidents.enrich_source(accidents.read_accident_source(spark, root, years=[2019, 2021]))
    assert {r.annee for r in chosen.collect()} == {2019, 2021}
    for kind, df in accidents.read_accident_source(spark, root, years=[2019, 2021]).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "2019" in plan.split("PartitionFilters: [")[1].split("]")[0], kind
        opened = {r[0].split("annee=")[1][:4] for r in df.select(F.input_file_name()).distinct().collect()}
        assert opened <= {"2019", "2021"}


def test_pandas_files_read_by_several_threads(spark, tmp_path):
    """Reading such a schema changes a session setting for a moment: no other thread may see it."""
    from concurrent.futures import ThreadPoolExecutor

    before = spark.conf.get(loaders.NANOS_AS_LONG, None)
    frame = pd.DataFrame({"inception_date": [pd.Timestamp("2023-05-01 12:00:00.000000001")]})
    paths = [str(tmp_path / f"{i}.parquet") for i in range(6)]
    for path in paths:
        frame.to_parquet(path)
    with ThreadPoolExecutor(6) as pool:
        read = list(pool.map(lambda p: loaders.read_raw_parquet(spark, p), paths * 3))
    assert {df.schema["inception_date"].dataType.typeName() for df in read} == {"date"}
    assert spark.conf.get(loaders.NANOS_AS_LONG, None) == before
