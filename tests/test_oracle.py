"""Every registered query against its SQL oracle (DuckDB) on the sf0.001 tables:
same column names, same row count, same multiset of values."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from actuaria.sources.tables import DRIVER_TABLES, table_path
from tests.conftest import SF_SMALL

QUERIES = contract.QUERIES
ORACLE = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return None if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows),
        key=lambda t: tuple("" if x is None else x for x in t),
    )


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = table_path(SF_SMALL, t)
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = df.collect()
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    duck_types = dict(zip(cols, map(str, duck.sql(ORACLE[name]).types)))
    for field in df.schema.fields:
        spark_type = field.dataType.simpleString()
        assert SPARK_TO_DUCKDB.get(spark_type, spark_type.upper()) == duck_types[field.name], field.name
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(cols, want)

