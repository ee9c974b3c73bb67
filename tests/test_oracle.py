"""Every registered query equals its SQL oracle (DuckDB) on the smallest scale folder."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from tavola.plans.registry import QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = {name: sql for name, sql in E.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(SQL[name])
    d_names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_names)
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    b = rows_of(d_names, cur.fetchall())
    assert isinstance(a, Counter) and a == b


@pytest.mark.parametrize("name", ["B02_signup_to_purchase", "C20_delivery_report", "A09_by_hour", "D12_member_rank"])
def test_time_answers_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = E.queries()[name](spark, SF)
        cur = con.execute(SQL[name])
        d_names = [c[0] for c in cur.description]
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(d_names, cur.fetchall())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
