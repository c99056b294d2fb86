"""What the written layouts are for: joins on the order without a shuffle, and
scans of the slice's months only."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from shopstar.catalog import SLICE
from shopstar.operators.ordering import global_order
from shopstar.plans import analytics as A
from shopstar.plans import quality as Q
from shopstar.plans.pipeline import BY_ORDER, read_staging, write_staging
from shopstar.plans.star import build_star, order_lines
from shopstar.sources.bucketed import open_bucketed, write_bucketed
from shopstar.sources.store import ParquetStore


@pytest.fixture(scope="module")
def staging(spark, small_warehouse, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("staging"))
    counts = write_staging(spark, small_warehouse.staged, folder, buckets=4)
    assert counts == {n: df.count() for n, df in small_warehouse.staged.items()}
    return folder


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_and_sums_per_order_need_no_shuffle(spark, small_warehouse, staging, no_broadcast):
    stg = read_staging(spark, staging)
    lines = order_lines(stg)
    assert "SortMergeJoin" in plan(lines) and "Exchange" not in plan(lines)
    assert "Exchange" in plan(order_lines(small_warehouse.staged))
    for check in (Q.order_total_check, Q.payment_total_check):
        found = re.findall(r"Exchange (\w+)", plan(check("staging", stg)))
        assert set(found) == {"SinglePartition"}  # one row of each task's partial counts
        assert check("staging", stg).collect() == check("staging", small_warehouse.staged).collect()
    for name in BY_ORDER:
        assert stg[name].dtypes == small_warehouse.staged[name].dtypes
        assert stg[name].exceptAll(small_warehouse.staged[name]).isEmpty()
    want = order_lines(small_warehouse.staged)
    assert lines.select(*want.columns).exceptAll(want).isEmpty() and lines.count() == want.count()


def test_a_bucketed_table_is_found_again(spark, tmp_path):
    df = spark.range(50).selectExpr("id AS order_id", "cast(id AS string) AS `a b`")
    assert write_bucketed(df, str(tmp_path), "t", "order_id", 3) == 50
    assert write_bucketed(df.where("order_id < 20"), str(tmp_path), "t", "order_id", 5) == 20  # laid out anew
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
    again = open_bucketed(spark, str(tmp_path), "t")
    assert again.count() == 20 and again.dtypes == df.dtypes
    assert "Exchange" not in plan(again.groupBy("order_id").count())


def test_running_sums_shuffle_once(spark):
    """The range shuffle of the ordering itself is in the written table's job."""
    df = spark.range(5000).selectExpr("id", "id % 7 AS v")
    out = global_order(df, ["v", "id"], "rank", running_sums={"total": "v"})
    assert "Window" in plan(out) and set(re.findall(r"(?<!Broadcast)Exchange (\w+)", plan(out))) <= {"SinglePartition"}
    want, total = [], 0
    for k, (v, i) in enumerate(sorted((i % 7, i) for i in range(5000)), 1):
        total += v
        want.append((i, v, k, total))
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


@pytest.fixture(scope="module")
def written_star(spark, staging, tmp_path_factory):
    return build_star(read_staging(spark, staging), ParquetStore(spark, str(tmp_path_factory.mktemp("star"))))


QUESTIONS = [A.kpi_summary, A.revenue_by_category, A.revenue_by_product, A.sales_trend, A.category_trend,
             A.customer_segments, A.repeat_vs_one_time, A.top_customers, A.revenue_concentration, A.clv_distribution,
             A.channel_performance, A.channel_product_matrix, A.promotion_performance]


@pytest.mark.parametrize("question", QUESTIONS, ids=lambda f: f.__name__)
def test_sliced_questions_read_the_slice_s_months(small_warehouse, written_star, question):
    got = question(written_star, filters=SLICE)
    if question is not A.revenue_concentration:  # writes its order; the scan is in that job
        filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(got))
        assert any("order_month" in f for f in filters)
        if question is A.kpi_summary:
            assert any("return_month" in f for f in filters)
    assert got.collect() == question(small_warehouse.star, filters=SLICE).collect()


def test_only_the_slice_s_folders_are_read(written_star):
    sales = written_star["fact_sales"]
    folders = {int(re.search(r"order_month=(\d+)", f)[1]) for f in sales.inputFiles()}
    assert len(folders) == sales.select("order_month").distinct().count()
    one = type(SLICE)(start_date=dt.date(1997, 2, 10), end_date=dt.date(1997, 2, 20)).sales(written_star)
    assert one.select("order_month").distinct().collect() == [(199702,)]
