"""Queries with a SQL form, against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from shopstar.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(oracle_sql()[name])
    columns = [c[0] for c in rel.description]
    got = queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) \
        == sorted(rel.fetchall(), key=repr)


def test_each_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")] == list(range(1, 14))
