"""Staging and star builders on hand-made source frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from shopstar.plans import staging, star
from shopstar.sources.schemas import PRODUCT_DOCUMENT, SOURCE

D = Decimal


def _src(spark, **rows):
    empty = {n: [] for n in SOURCE}
    empty["products"] = []
    empty.update(rows)
    out = {n: spark.createDataFrame(r, SOURCE[n]) for n, r in empty.items() if n in SOURCE}
    out["products"] = spark.createDataFrame(empty["products"], PRODUCT_DOCUMENT)
    return out


def _doc(pid, name=" Widget ", brand=("Acme",), cat=("Tools", "Home", "Home/Tools"),
         pricing=(D("10.00"), D("4.00"), "USD"), attrs='{"a": 1}', variants=None, tags=None,
         created="2024-01-01T00:00:00+00:00"):
    return (pid, name, "d", brand, cat, pricing, attrs, variants, tags, (created, "x"))


def test_stage_products_flattens_with_defaults(spark):
    src = _src(spark, products=[
        _doc("P1", tags=["a", "b"], variants=[(None, "red", "M", 1)] * 2),
        _doc("P2", brand=None, cat=None, pricing=None, attrs=None, created="bad"),
        _doc("P3", cat=("", " Garden\t", None)),
    ])
    rows = {r.product_id: r for r in staging.stage_products(src).collect()}
    assert rows["P1"].product_name == "Widget" and rows["P1"].tags == "a,b"
    assert rows["P1"].variant_count == 2 and rows["P1"].created_at == dt.datetime(2024, 1, 1)
    p2 = rows["P2"]
    assert (p2.brand, p2.category_name, p2.parent_category) == (None, "Unknown", "Unknown")
    assert (p2.price, p2.cost, p2.tags, p2.attributes, p2.variant_count, p2.created_at) == \
        (D("0.00"), D("0.00"), "", "{}", 0, None)
    assert (rows["P3"].category_name, rows["P3"].parent_category) == ("Unknown", "Garden")


def test_stage_customers_billing_left_join_lower_email(spark):
    src = _src(spark, customers=[(1, " Ann ", "Lee", " ANN@X.COM ", None, dt.date(2024, 1, 1)),
                                 (2, "Bo", "Ng", "bo@x.com", None, None)],
               customer_addresses=[(10, 1, "billing", "s", "Oslo", "S", "NO", "1"),
                                   (11, 1, "shipping", "s", "Rome", "S", "IT", "1"),
                                   (12, 2, "shipping", "s", "Lima", "S", "PE", "1")])
    rows = {r.customer_id: r for r in staging.stage_customers(src).collect()}
    assert rows[1].first_name == "Ann" and rows[1].email == "ann@x.com"
    assert rows[1].city == "Oslo" and rows[2].city is None


def _staged(spark):
    ts = dt.datetime
    src = _src(
        spark,
        sales_channels=[(1, "web", "web"), (2, "app", "mobile")],
        promotions=[(7, "P7", "d", "percentage", D("10.00"), dt.date(2024, 1, 1),
                     dt.date(2024, 1, 31))],
        customers=[(1, "A", "B", "a@x.com", None, None), (2, "C", "D", "c@x.com", None, None)],
        orders=[(100, 1, 1, 7, ts(2024, 12, 30, 10), "delivered", D("30.00")),
                (101, 2, 2, None, ts(2027, 1, 1), "cancelled", D("5.00")),
                (102, 9, 1, None, ts(2025, 1, 1), "shipped", D("1.00"))],  # unknown customer
        order_items=[(1, 100, "P1", 2, D("10.00"), D("1.00"), D("19.00")),
                     (2, 100, "P2", 1, D("11.00"), D("0.00"), D("11.00")),
                     (3, 101, "P1", 1, D("5.00"), D("0.00"), D("5.00")),
                     (4, 102, "P1", 1, D("1.00"), D("0.00"), D("1.00")),
                     (5, 100, "PX", 1, D("1.00"), D("0.00"), D("1.00"))],  # unknown product
        payments=[(1, 100, "paypal", D("30.00"), None, "completed"),
                  (2, 100, "gift_card", D("1.00"), None, "completed")],
        returns=[(9, 100, 1, ts(2025, 1, 2), 1, D("9.50"), "x")],
        products=[_doc("P1"), _doc("P2", cat=("Saws", "Home", "p"))],
    )
    return staging.stage_all(src)


def test_star_semantics(spark):
    s = star.build_star(_staged(spark))
    promo = {r.promotion_key: r for r in s["dim_promotion"].collect()}
    assert promo[1].promotion_code == "NONE" and promo[2].promotion_id == 7
    methods = {r.payment_method_key: r.payment_method for r in s["dim_payment_method"].collect()}
    assert methods == {0: "UNKNOWN", 1: "gift_card", 2: "paypal"}
    cats = [(r.category_key, r.category_name) for r in s["dim_category"].orderBy("category_key").collect()]
    assert cats == [(1, "Saws"), (2, "Tools")]
    f = {r.order_item_id: r for r in s["fact_sales"].collect()}
    assert sorted(f) == [1, 2, 3]  # unknown customer / product lines are dropped
    assert [f[i].sales_key for i in (1, 2, 3)] == [1, 2, 3]
    assert f[1].promotion_key == 2 and f[3].promotion_key == 1
    assert f[1].payment_method_key == 2 and f[3].payment_method_key == 0  # lowest payment id
    assert f[1].gross_revenue == D("20.00") and f[1].net_revenue == D("19.00")
    assert f[3].order_date_key == 20270101  # cancelled orders still count
    r = s["fact_returns"].collect()
    assert len(r) == 1 and r[0].return_date_key == 20250102 and r[0].return_key == 1


def test_dim_date_calendar(spark):
    d = {r.date_key: r for r in star.dim_date(_staged(spark)).collect()}
    assert min(d) == 20241230 and max(d) == 20270101 and len(d) == 733
    assert d[20241230].week_of_year == 1 and d[20241230].day_of_week == 1
    assert d[20241230].day_name == "Monday" and d[20241230].month_name == "December"
    assert d[20270101].week_of_year == 53 and d[20270101].is_weekend is False
    assert d[20250104].is_weekend is True and d[20250104].quarter == 1


def test_empty_returns_give_typed_empty_fact(spark):
    stg = _staged(spark)
    stg["stg_returns"] = stg["stg_returns"].limit(0)
    s = star.build_star(stg)
    assert s["fact_returns"].count() == 0
    assert s["fact_returns"].columns[0] == "return_key"
    assert s["dim_date"].count() > 0  # orders only
