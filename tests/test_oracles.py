"""Every query that has SQL gives the rows that DuckDB gives, under the same names."""

from __future__ import annotations

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry
from lakeloom.plans import catalogue
from lakeloom.plans.adapters import TABLES
from tests.conftest import SF


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    if isinstance(x, (bytes, bytearray)):
        return bytes(x).hex()
    if isinstance(x, (datetime.date, datetime.datetime)):
        return x.isoformat()
    return str(x)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    want = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plan_pushes_filters_and_columns(spark):
    plan = "\n".join(r[0] for r in catalogue.queries()["q2c_explain"](spark, SF).collect())
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_quantity), EqualTo(l_returnflag,R), GreaterThan(l_quantity,30.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan
