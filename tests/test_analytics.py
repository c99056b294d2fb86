"""Business questions on a tiny hand-made star: ties, empty slices, zero
revenue, limits, and invariants (Pareto ends at 100 %, ranks 1..n)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from shopstar.functions.filters import QueryFilters
from shopstar.plans import analytics as A
from shopstar.sources.schemas import STAR

D = Decimal


@pytest.fixture(scope="module")
def tiny(spark):
    rows = {
        "dim_date": [(20240101 + i, dt.date(2024, 1, 1 + i), 2024, 1, 1, "January", 1 + i, 1, "x",
                      1, False) for i in range(5)],
        "dim_customer": [(1, 1, "Ann Lee", "a@x", "Oslo", "S", "NO", None),
                         (2, 2, "Bo Ng", "b@x", "Lima", "S", "PE", None),
                         (3, 3, "Ann Lee", "c@x", "Oslo", "S", "NO", None)],
        "dim_category": [(1, "Saws", "Tools"), (2, "Pots", "Home")],
        "dim_product": [(1, "P1", "Saw", "Acme", 1, "Saws", D(1), D(1)),
                        (2, "P2", "Pot", "Acme", 2, "Pots", D(1), D(1)),
                        (3, "P3", "Saw", "Acme", 1, "Saws", D(1), D(1))],
        "dim_channel": [(1, 1, "web", "web"), (2, 2, "app", "mobile")],
        "dim_promotion": [(1, None, "NONE", "n", "none", D(0)),
                          (2, 7, "P7", "d", "percentage", D(10))],
        "dim_payment_method": [(0, "UNKNOWN")],
        # sales_key, order, item, date, cust, prod, cat, ch, promo, pay, qty, unit, g, d, n
        "fact_sales": [
            (1, 10, 1, 20240101, 1, 1, 1, 1, 1, 0, 2, D(50), D(100), D(0), D(100)),
            (2, 10, 2, 20240101, 1, 2, 2, 1, 1, 0, 1, D(100), D(100), D(0), D(100)),  # tie
            (3, 11, 3, 20240102, 2, 3, 1, 2, 2, 0, 3, D(100), D(300), D(30), D(270)),
            (4, 12, 4, 20240103, 3, 1, 1, 1, 2, 0, 1, D(20), D(20), D(2), D(18)),
            (5, 13, 5, 20240104, 1, 2, 2, 2, 1, 0, 1, D(12), D(12), D(0), D(12)),
        ],
        "fact_returns": [(1, 1, 10, 1, 20240105, 1, 1, 1, 1, D(50), "x")],
    }
    return {n: spark.createDataFrame(r, STAR[n]) for n, r in rows.items()}


def test_kpi_and_empty_slice(tiny):
    k = A.kpi_summary(tiny).collect()[0]
    assert (k.orders, k.customers, k.net_revenue, k.units_sold, k.refunds) == (4, 3, 500.0, 8, 50.0)
    e = A.kpi_summary(tiny, QueryFilters(start_date=dt.date(2030, 1, 1))).collect()
    assert len(e) == 1 and (e[0].orders, e[0].net_revenue, e[0].refunds) == (0, None, 0.0)


def test_kpi_approximate_distinct(tiny):
    a = A.kpi_summary(tiny, approx_distinct=True).collect()[0]
    assert (a.orders, a.customers, a.net_revenue) == (4, 3, 500.0)


def test_filters_combine(tiny):
    f = QueryFilters(start_date=dt.date(2024, 1, 2), end_date=dt.date(2024, 1, 4),
                     categories=("Tools",), channels=("web",))
    rows = A.revenue_by_category(tiny, f).collect()
    assert [(r.category_name, r.net_revenue) for r in rows] == [("Saws", 18.0)]
    with pytest.raises(ValueError):
        QueryFilters(start_date=dt.date(2024, 2, 1), end_date=dt.date(2024, 1, 1))


def test_top_products_merge_same_names_and_ties(tiny):
    with pytest.raises(ValueError):
        A.revenue_by_product(tiny, limit=0)
    rows = A.revenue_by_product(tiny, limit=1).collect()
    assert len(rows) == 1 and rows[0].product_name == "Saw" and rows[0].net_revenue == 388.0
    cust = A.top_customers(tiny, limit=500).collect()
    assert [(r.full_name, r.orders, r.lifetime_value) for r in cust] == \
        [("Ann Lee", 3, 230.0), ("Bo Ng", 1, 270.0)][::-1]


def test_pareto_curve_ranks_and_end(tiny):
    curve = A.revenue_concentration(tiny).collect()
    assert [r.rank for r in curve] == [1, 2, 3]
    assert curve[-1].cumulative_revenue_pct == 100.0 and curve[-1].entity_pct == 100.0
    # product 1 (118) vs 2 (112) vs 3 (270): ties broken by key
    assert [r.cumulative_revenue_pct for r in curve] == [54.0, 77.6, 100.0]
    th = A.pareto_threshold(tiny).collect()[0]
    assert th.entity_pct == 100.0 and th.entities == 3  # 77.6 % < 80 % after two
    half = A.pareto_threshold(tiny, share=50.0).collect()[0]
    assert half.entity_pct == 33.33 and half.entities == 1


def test_zero_revenue_pareto_is_null(tiny, spark):
    zero = dict(tiny)
    zero["fact_sales"] = tiny["fact_sales"].withColumn("net_revenue", tiny["fact_sales"].quantity * 0)
    rows = A.revenue_concentration(zero).collect()
    assert all(r.cumulative_revenue_pct is None for r in rows)


def test_channel_matrix_and_segments(tiny):
    m = A.channel_product_matrix(tiny, limit=1).collect()
    assert [(r.channel_name, r.product_name, r.rank) for r in m] == [("app", "Saw", 1),
                                                                     ("web", "Saw", 1)]
    seg = {r.spending_tier: r.customers for r in A.customer_segments(tiny).collect()}
    assert seg == {"Mid (250-1k)": 1, "Low (<250)": 2}
    rep = {r.buyer_type: (r.customers, r.avg_orders) for r in A.repeat_vs_one_time(tiny).collect()}
    assert rep == {"Repeat buyers": (1, 2.0), "One-time buyers": (2, 1.0)}


def test_trends_histogram_and_promo(tiny):
    day = A.sales_trend(tiny, "day").collect()
    assert [r.period for r in day] == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    month = A.sales_trend(tiny, "quarterly").collect()  # anything else means month
    assert len(month) == 1 and month[0].orders == 4
    hist = A.clv_histogram(tiny, bins=50).collect()
    assert sum(r.customers for r in hist) == 3 and hist[-1].bucket == 50
    pv = A.promo_vs_baseline(tiny).collect()[0]
    assert (pv.promo_orders, pv.avg_items_promo, pv.avg_items_baseline, pv.avg_items_delta) == \
        (2, 2.0, 1.33, 0.67)
    long = A.gross_net_long(tiny).collect()
    assert len(long) == 4 and {r.measure for r in long} == {"gross_revenue", "net_revenue"}
