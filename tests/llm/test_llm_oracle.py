"""Queries that SQL can state equal their DuckDB SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

from tavola.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())
