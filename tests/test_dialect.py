"""CSV dialects found on a sample, typed reads that lose nothing."""

import datetime as dt

import pytest

from actuaria.sources import dialect, loaders


def found(text, whole=True, encoding="utf-8"):
    return dialect.sniff(text.encode(encoding), whole)


def kinds(d):
    return [t.name + (f" {t.pattern}" if t.pattern else "") for t in d.types]


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
@pytest.mark.parametrize("quote", ["", '"', "'"])
@pytest.mark.parametrize("header", [True, False])
def test_separators_quotes_and_headers(sep, quote, header):
    rows = [["id", "name", "day"]] * header + [[str(i), f"n{i}", f"2024-01-0{i}"] for i in range(1, 7)]
    if quote:
        rows[-1][1] = f"a{sep}b{quote}{quote}c"
    text = "\n".join(sep.join(f"{quote}{v}{quote}" for v in r) for r in rows) + "\n"
    d = found(text)
    assert (d.sep, d.header) == (sep, header) and (not quote or d.quote == quote)
    assert kinds(d) == ["int", "string", "date yyyy-MM-dd"]
    assert d.columns == (("id", "name", "day") if header else ("c0", "c1", "c2"))


def test_types_and_formats():
    text = "a;b;c;d;e;f;g\n1,5;31/12/2023;true;007;2024-01-02 03:04:05;9999999999;x\n-0,25;01/02/2024;FALSE;1;2024-01-03 03:04:05;;\n"
    d = found(text)
    assert kinds(d) == ["double ,", "date dd/MM/yyyy", "boolean", "string", "timestamp yyyy-MM-dd HH:mm:ss", "bigint", "string"]
    assert kinds(found("n\n1\n2\n", whole=False)) == ["bigint"]  # larger ones may follow
    assert kinds(found("n,m\n1,\n2.5,\n1e5,\n")) == ["double", "string"]


def test_odd_samples():
    assert found("one\ntwo\nthree\n").columns == ("one",) and found("x\nx\ny\n").header is False
    assert found("a,a,A\n1,2,3\n").columns == ("a", "a_2", "A_3")
    assert found("Père;é\n1;2\n", encoding="latin-1").encoding == "ISO-8859-1"
    assert found("﻿id,v\n1,2\n").columns == ("id", "v")
    cut = "id,v\n1,é\n2,é".encode()[:-1]  # the sample ends inside a character
    assert dialect.sniff(cut, False).encoding == "UTF-8"
    assert found("# made by hand\nid;v\n1;2\n3;4\n").columns == ("id", "v")
    assert found('id,v\n1,"two\nlines"\n').multiline
    for nothing in ("", "\n\n"):
        with pytest.raises(dialect.UnreadableSample):
            found(nothing)


def test_typed_read_keeps_what_does_not_fit(spark, tmp_path):
    path = tmp_path / "claims.csv"
    body = [f"{i};{i},50;0{i % 9 + 1}/02/2024;n{i}" for i in range(20_000)]
    body[15_000] = "x1;2,00;31/12/2023;bad number"
    body[15_001] = "15001;2,00;2024-02-30;bad day"
    body[15_002] = "15002;2,00"
    path.write_text("id;cost;day;name\n" + "\n".join(body) + "\n")
    df = dialect.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"id": "bigint", "cost": "double", "day": "date", "name": "string", "_rejected": "string"}
    rows = df.collect()
    assert len(rows) == 20_000
    bad = {r["_rejected"]: r for r in rows if r["_rejected"]}
    assert set(bad) == {"id=x1", "day=2024-02-30", "15002;2,00"}
    assert bad["id=x1"]["id"] is None and bad["id=x1"]["name"] == "bad number"
    good = next(r for r in rows if r["id"] == 7)
    assert (good["cost"], good["day"], good["name"]) == (7.5, dt.date(2024, 2, 8), "n7")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_loads_fail_whole_or_keep_rejects(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id\tv\n" + "\n".join(f"{i}\t{i}" for i in range(60_000)) + "\n")
    assert loaders.load_csv(spark, str(path), "dialect_t") == 60_000
    path.write_text(path.read_text() + "late\t1\n")
    with pytest.raises(Exception, match="does not fit the sample"):
        loaders.load_csv(spark, str(path), "dialect_t")
    assert spark.table("raw.dialect_t").count() == 60_000
    assert loaders.load_csv(spark, str(path), "dialect_t", rejects="why") == 60_001
    assert [r["why"] for r in spark.table("raw.dialect_t").where("why is not null").collect()] == ["id=late"]
    loaders.drop(spark, "dialect_t")


def test_folders_and_missing_files(spark, tmp_path):
    spark.range(100).selectExpr("id", "concat('n', id) as name").repartition(3).write.option("header", True).csv(str(tmp_path / "out"))
    df = dialect.read_csv(spark, str(tmp_path / "out"), rejects=None)
    assert df.columns == ["id", "name"] and df.count() == 100
    with pytest.raises(dialect.UnreadableSample):
        dialect.read_csv(spark, str(tmp_path / "no-such-file.csv"))
