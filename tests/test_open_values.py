"""Open attributes as values, and distinct counts from stored sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopstar.catalog import SLICE
from shopstar.plans import analytics as A
from shopstar.plans.attributes import attribute, attribute_counts, attribute_rows, with_attributes
from shopstar.plans.sketches import daily_sketches, sketched_kpis

PRODUCTS = [("P1", "Tools", '{"size": 3, "colour": "red", "dims": {"w": 1}}'), ("P2", "Tools", '{"size": 4.5, "colour": "red"}'),
            ("P3", "Tools", '{"size": "big", "sharp": true, "it\'s": null}'), ("P4", "Toys", "{}"), ("P5", "Toys", '{"size": 3}')]


def products(spark):
    return spark.createDataFrame(PRODUCTS, "product_id string, parent_category string, attributes string")


def test_attributes_by_path_and_as_rows(spark):
    df = with_attributes(products(spark))
    got = {r.product_id: (r.size, r.colour) for r in df.select(
        "product_id", attribute("size", "double").alias("size"), attribute("colour", "string").alias("colour")).collect()}
    assert got == {"P1": (3.0, "red"), "P2": (4.5, "red"), "P3": (None, None), "P4": (None, None), "P5": (3.0, None)}
    rows = {(r.product_id, r.attribute): (r.kind, r.value) for r in attribute_rows(products(spark)).collect()}
    assert rows[("P1", "dims")] == ("other", '{"w":1}') and rows[("P3", "sharp")] == ("boolean", "true")
    assert len(rows) == 9 and not [k for k in rows if k[0] == "P4"]
    counts = {(r.parent_category, r.attribute, r.kind): tuple(r)[3:] for r in attribute_counts(products(spark)).collect()}
    assert counts[("Tools", "size", "number")] == (2, 2, 3.0, 4.5) and counts[("Tools", "colour", "text")] == (2, 1, None, None)
    assert counts[("Tools", "size", "text")][:2] == (1, 1) and counts[("Toys", "size", "number")] == (1, 1, 3.0, 3.0)


def test_a_slice_s_counts_from_sketches(spark, small_warehouse, tmp_path):
    star = small_warehouse.star
    daily_sketches(star).write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    for filters in (SLICE, type(SLICE)()):
        got = sketched_kpis(star, stored, filters).first()
        want = A.kpi_summary(star, filters).first()
        assert abs(got.orders - want.orders) <= 0.03 * want.orders
        assert abs(got.customers - want.customers) <= 0.03 * want.customers
        assert float(got.net_revenue) == want.net_revenue and got.units_sold == want.units_sold
    months = sketched_kpis(star, stored, type(SLICE)(), "year", "month")
    exact = star["fact_sales"].agg(F.sum("net_revenue")).first()[0]
    assert months.agg(F.sum("net_revenue")).first()[0] == exact
    assert "fact_sales" not in months._jdf.queryExecution().analyzed().toString()
