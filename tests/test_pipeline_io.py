"""Files in and out, value for value; the batch run from landing files to the
published build, its gates, run log and audit."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pytest

from shopstar.plans import analytics as A
from shopstar.plans import quality as Q
from shopstar.functions.cleaning import nan_to_null
from shopstar.plans.pipeline import current_build, last_refresh, published_star, run_pipeline
from shopstar.sources.io import (SourceNotFound, export_sources, read_csv, read_documents, read_landing,
                                 read_sources, read_sql, write_csv)
from shopstar.session import scratch_scope
from shopstar.sources.schemas import SOURCE
from shopstar.sources.store import written


def test_missing_source_is_a_clear_error(spark):
    with pytest.raises(SourceNotFound):
        read_csv(spark, "/nonexistent/orders.csv", SOURCE["orders"])


def test_whole_file_json_documents(spark, tmp_path):
    """A document collection exported as one JSON array (store id included)."""
    path = tmp_path / "products.json"
    path.write_text('[{"_id": {"$oid": "x"}, "product_id": "P1", "name": " Saw ", '
                    '"brand": {"name": "Acme"}, "category": {"name": "Saws", "parent": "Tools"},'
                    ' "pricing": {"price": 9.5}, "tags": ["a", "b"], "variants": [],'
                    ' "metadata": {"created_at": "2024-01-01T00:00:00+00:00"}},'
                    ' {"product_id": "P2", "pricing": null}]')
    docs = read_documents(spark, str(path), multi_line=True)
    assert "_id" not in docs.columns
    rows = {r.product_id: r for r in docs.collect()}
    assert rows["P1"].pricing.price == Decimal("9.50") and rows["P2"].pricing is None


def test_parameterised_sql(spark):
    df = read_sql(spark, "SELECT * FROM VALUES (1, 'billing'), (2, 'shipping') AS t(id, kind) "
                         "WHERE kind = :kind", {"kind": "billing"})
    assert [r.id for r in df.collect()] == [1]


LANDING = {
    "sales_channels": 'channel_id,channel_name,channel_type\n1,"  Shop, main ",web\n2,"he said ""hi""",web\n',
    "promotions": "promotion_id,promotion_code,description,discount_type,discount_value,start_date,end_date\n"
                  '1,P1,"two\nlines",percentage,10.0,2024-01-01,2024-02-01\n',
    "customers": "customer_id,first_name,last_name,email,phone,signup_date\n"
                 "1,Ann,Lee,  A@x.com,,2024-01-01\n2,Bo,Ray,b@x.com,NA,2024-01-02\n",
    "customer_addresses": "address_id,customer_id,address_type,street,city,state,country,postal_code\n"
                          "1,1,billing,S 1,C,T,U,00123\n2,2,billing,S 2,C,T,U,\n",
    "orders": "order_id,customer_id,channel_id,promotion_id,order_date,status,total_amount\n"
              "1,1,1,1.0,2024-01-05 10:00:00,delivered,20.00\n2,2,2,,2024-01-06 11:30:00,shipped,5.5\n",
    "order_items": "order_item_id,order_id,product_id,quantity,unit_price,discount_amount,line_total\n"
                   "1,1,P1,2,10.00,0.0,20.00\n2,2,P1,1,5.50,0.0,5.50\n",
    "payments": "payment_id,order_id,payment_method,amount,payment_date,status\n"
                "1,1,paypal,20.00,2024-01-05 10:01:00,completed\n",
    "returns": "return_id,order_id,order_item_id,return_date,quantity,refund_amount,reason\n"
               "1,1,1,2024-01-09 00:00:00,1,10.00,Wrong size\n",
}
CATALOG = ('[{"_id": "x", "product_id": "P1", "name": " Saw ", "brand": {"name": "Acme"}, '
           '"category": {"name": "Saws", "parent": "Tools"}, "pricing": {"price": 9.5, "cost": 4}}]')


@pytest.fixture()
def landing(tmp_path):
    for name, text in LANDING.items():
        (tmp_path / f"{name}.csv").write_text(text)
    (tmp_path / "products.json").write_text(CATALOG)
    return tmp_path


def test_landing_files_in_the_frame_dialect(spark, landing):
    src = read_landing(spark, str(landing))
    assert [r.channel_name for r in src["sales_channels"].orderBy("channel_id").collect()] == [
        "  Shop, main ", 'he said "hi"']
    assert src["promotions"].first().description == "two\nlines"
    assert [r.promotion_id for r in src["orders"].orderBy("order_id").collect()] == [1, None]
    assert src["customers"].where("customer_id = 1").first().email == "  A@x.com"
    assert [r.postal_code for r in src["customer_addresses"].orderBy("address_id").collect()] == ["00123", None]
    for name, schema in SOURCE.items():
        assert [(f.name, f.dataType) for f in src[name].schema] == [(f.name, f.dataType) for f in schema]


@pytest.mark.parametrize("bad", ["1,1,1,1.5,2024-01-05 10:00:00,delivered,20.00",
                                 "1,1,1,one,2024-01-05 10:00:00,delivered,20.00",
                                 "1,1,1,1,yesterday,delivered,20.00", "1,1,1,1,2024-01-05 10:00:00"])
def test_malformed_rows_are_errors(spark, landing, bad):
    (landing / "orders.csv").write_text(LANDING["orders"] + bad + "\n")
    with pytest.raises(Exception):
        read_landing(spark, str(landing))["orders"].collect()


def test_malformed_documents_are_errors(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"product_id": "P1"}\n{"product_id": \n')
    with pytest.raises(Exception):
        read_documents(spark, str(tmp_path / "p.json")).collect()


def test_csv_round_trip_keeps_every_value(spark, tmp_path):
    schema = SOURCE["customers"]
    rows = [(1, "  lead", "trail  ", 'q"uo"te', "new\nline", None), (2, "", None, "a,b", "back\\slash", dt.date(2024, 5, 1)),
            (None, " ", "\t tab", '"', "c\r\nd", None), (4, "é", "日本", "'", ",", dt.date(1999, 1, 1))]
    df = spark.createDataFrame(rows, schema)
    assert write_csv(df, str(tmp_path / "c")) == 4
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "c"), schema).collect()), key=repr) == sorted(rows, key=repr)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.5, "nan"), (float("nan"), "x"), (None, None)], "x double, s string")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(1.5, "nan"), (None, "x"), (None, None)]


def test_run_from_landing_files(spark, landing, tmp_path):
    lake = str(tmp_path / "lake")
    counts = run_pipeline(spark, str(landing), lake, as_of=dt.date(2024, 3, 1))
    assert counts["orders"] == counts["stg_orders"] == 2 and counts["fact_sales"] == 2
    assert published_star(spark, lake)["fact_returns"].count() == 1
    (landing / "orders.csv").unlink()
    with pytest.raises(SourceNotFound):
        run_pipeline(spark, str(landing), lake, steps=("load-sources",))


def test_a_run_leaves_no_scratch_tables(spark, landing, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.iterdir())
    run_pipeline(spark, str(landing), str(tmp_path / "lake"), as_of=dt.date(2024, 3, 1))
    assert set(shared.iterdir()) <= before
    with scratch_scope(spark):
        kept = written(spark.range(5), "five")
        assert kept.count() == 5 and set(shared.iterdir()) - before
    assert set(shared.iterdir()) <= before


def test_no_build_is_published_without_its_gate(spark, landing, tmp_path):
    lake = str(tmp_path / "lake")
    run_pipeline(spark, str(landing), lake, as_of=dt.date(2024, 3, 1))
    good = current_build(spark, lake)
    (landing / "order_items.csv").write_text(LANDING["order_items"].replace("0.0,5.50", "1.0,5.50"))
    run_pipeline(spark, str(landing), lake, steps=("load-sources", "stage"))
    with pytest.raises(Q.DataQualityError):  # gross - discount is not net
        run_pipeline(spark, str(landing), lake, steps=("transform",), as_of=dt.date(2024, 3, 1))
    assert current_build(spark, lake) == good
    with pytest.raises(Q.DataQualityError):  # too old
        run_pipeline(spark, str(landing), lake, steps=("quality-analytics",), as_of=dt.date(2030, 3, 1))


def test_a_crash_while_publishing_keeps_the_old_build(spark, landing, tmp_path, monkeypatch):
    from shopstar.plans import pipeline
    lake = str(tmp_path / "lake")
    run_pipeline(spark, str(landing), lake, as_of=dt.date(2024, 3, 1))
    good = current_build(spark, lake)

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(pipeline, "publish", crash)
    with pytest.raises(OSError):
        run_pipeline(spark, str(landing), lake, steps=("transform",), as_of=dt.date(2024, 3, 1))
    assert current_build(spark, lake) == good and published_star(spark, lake)["fact_sales"].count() == 2


def test_files_round_trip_and_full_run(spark, small_warehouse, tmp_path):
    manifest = export_sources(small_warehouse.sources, str(tmp_path / "landing"))
    sources = read_sources(spark, str(tmp_path / "landing"))
    assert {k: v.count() for k, v in sources.items()} == manifest["counts"]
    for name in SOURCE:
        assert sources[name].exceptAll(small_warehouse.sources[name]).isEmpty()
        assert small_warehouse.sources[name].exceptAll(sources[name]).isEmpty()
    back, products = sources["products"].drop("attributes"), small_warehouse.sources["products"].drop("attributes")
    assert back.exceptAll(products).isEmpty() and products.exceptAll(back).isEmpty()
    for path in (tmp_path / "landing" / "products.json").glob("part-*"):
        assert isinstance(json.loads(path.read_text()), list)  # each file an array, as landed
    lake = str(tmp_path / "lake")
    counts = run_pipeline(spark, str(tmp_path / "landing"), lake, as_of=dt.date(2002, 1, 1))  # all gates pass
    star = published_star(spark, lake)
    assert counts["fact_sales"] == counts["stg_order_items"] == star["fact_sales"].count()
    want = A.revenue_by_category(small_warehouse.star).collect()
    assert A.revenue_by_category(star).collect() == want
    assert last_refresh(spark, lake).collect()[0].step_name == "build_analytics"
    audit = spark.read.parquet(f"{lake}/etl_audit")
    runs = spark.read.parquet(f"{lake}/pipeline_runs")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert all(r.passed for r in Q.timeliness_checks(audit, runs, now).collect())
    late = {r.check_name: r.passed for r in
            Q.timeliness_checks(audit, runs, now + dt.timedelta(days=5)).collect()}
    assert late == {"last staging load is recent": False, "last build is recent": False,
                    "core tables audited": True}
    with pytest.raises(ValueError):
        run_pipeline(spark, sources, lake, steps=("publish-everything",))
