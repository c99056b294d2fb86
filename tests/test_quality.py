"""Each check must find a planted error, and the gate must stop the run."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopstar.plans import quality as Q


@pytest.fixture(scope="module")
def layers(small_warehouse):
    return small_warehouse.staged, small_warehouse.star


def _by_name(df):
    return {r.check_name: r for r in df.collect()}


def test_clean_data_passes_gates(layers):
    stg, star = layers
    assert all(r[4] for r in Q.gate(Q.staging_checks(stg)))
    Q.gate(Q.analytics_checks(star, as_of=dt.date(2002, 1, 1)))


def test_gate_raises_with_every_failure(layers):
    stg, _ = layers
    bad = {**stg, "stg_orders": stg["stg_orders"].withColumn("total_amount", F.col("total_amount") + 1)
           .withColumn("order_date", F.lit(None).cast("timestamp_ntz"))}
    with pytest.raises(Q.DataQualityError) as failure:
        Q.gate(Q.staging_checks(bad))
    assert "order total is the sum of its lines" in str(failure.value) and "every order has a date" in str(failure.value)


def test_planted_staging_errors_are_found(layers):
    stg, _ = layers
    bad = dict(stg)
    bad["stg_customers"] = stg["stg_customers"].withColumn(
        "email", F.when(F.col("customer_id") < 3, F.lit("")).otherwise(F.col("email")))
    bad["stg_orders"] = stg["stg_orders"].unionByName(stg["stg_orders"].limit(2)).withColumn(
        "order_date", F.when(F.col("order_id") == 1, None).otherwise(F.col("order_date")))
    bad["stg_order_items"] = stg["stg_order_items"].withColumn(
        "product_id", F.when(F.col("order_item_id") == 1, "NOPE").otherwise(F.col("product_id")))
    r = _by_name(Q.staging_checks(bad))
    assert r["every customer has an e-mail"].observed == 3
    assert r["no order id twice"].observed == 2
    assert r["every order has a date"].observed >= 1
    assert r["lines name a staged product"].observed == 1
    s = _by_name(Q.staging_suite(bad))
    assert s["emails have valid format"].observed == 3
    assert not s["customer email unique"].passed


def test_planted_star_errors_are_found(layers):
    _, star = layers
    bad = dict(star)
    f = star["fact_sales"]
    bad["fact_sales"] = f.withColumn(
        "product_key", F.when(F.col("sales_key") == 1, F.lit(10**9)).otherwise(F.col("product_key"))
    ).withColumn("net_revenue", F.when(F.col("sales_key") == 2, F.col("net_revenue") + 5)
                 .otherwise(F.col("net_revenue")))
    a = _by_name(Q.analytics_checks(bad, as_of=dt.date(2030, 1, 1)))
    assert a["sold products are in the product dimension"].observed == 1
    assert a["net is gross less discount"].observed == 1
    assert not a["newest sale is recent enough"].passed
    s = _by_name(Q.star_suite(bad))
    assert s["fact_sales.product_key resolves in dim_product"].observed == 1
    assert s["fact_sales.order_date_key resolves in dim_date"].observed == 0


def test_staleness_without_sales(layers):
    _, star = layers
    empty = dict(star)
    empty["fact_sales"] = star["fact_sales"].limit(0)
    r = _by_name(Q.analytics_checks(empty, as_of=dt.date(2002, 1, 1)))
    assert r["newest sale is recent enough"].observed == 99999


def test_planted_errors_are_found_by_every_check(spark, small_warehouse):
    """Each check of the suites observes something on the planted tables, but
    for rules the plants leave alone by name."""
    from shopstar.sources import planted as P
    stg, star = P.planted(small_warehouse.staged, P.STAGING), P.planted(small_warehouse.star, P.STAR)
    rows = [*Q.staging_checks(stg).collect(), *Q.staging_suite(stg).collect(), *Q.star_suite(star).collect(),
            *Q.analytics_checks(star, as_of=dt.date(2002, 1, 1)).collect()]
    assert [r.check_name for r in rows if r.observed == 0] == []


def test_a_table_is_scanned_once_for_all_its_keys(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS a", "id % 5 AS b", "id % 7 AS c").write.parquet(str(tmp_path / "t"))
    child, parent = spark.read.parquet(str(tmp_path / "t")), spark.range(3)
    out = Q.orphan_rule_rows("x", child, [(k, k, parent, "id") for k in "abc"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("LeftAnti") <= 2
    assert {r.check_name: r.observed for r in out.collect()} == {"a": 0, "b": 40, "c": 56}
