"""Every registered query against its DuckDB oracle on the smallest data,
and invariants that must not depend on the number of shuffle partitions."""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry
from oracles.queries import oracle_sql
from shopstar.catalog import queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows):
    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v
    return sorted((tuple(cell(v) for v in r) for r in rows), key=repr)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0 and "net_revenue" in df.columns


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF)
    rel = con.execute(oracle_sql()[name])
    o_cols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(o_cols)
    s_rows = [tuple(r[c] for c in sorted(sdf.columns)) for r in sdf.collect()]
    idx = [o_cols.index(c) for c in sorted(o_cols)]
    o_rows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _norm(s_rows) == _norm(o_rows)


def test_shuffle_partitions_do_not_change_results(spark, small_warehouse):
    from shopstar.plans import analytics as A
    star = small_warehouse.star
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append((A.revenue_concentration(star, "customer").collect(),
                        A.channel_product_matrix(star).collect(),
                        A.kpi_summary(star).collect()))
        assert out[0] == out[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
