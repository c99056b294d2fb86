"""What keeps the warehouse's moved bytes in step with its input."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shopstar import catalog
from shopstar.functions.cleaning import dedupe_first, dedupe_rare
from shopstar.operators.ordering import global_order, place_rows, ranges
from shopstar.plans import star as star_module
from shopstar.plans.quality import duplicate_rule_rows, orphan_rule_rows
from shopstar.plans.sketches import stored_sketches
from shopstar.plans.staging import stage_on_demand
from shopstar.plans.warehouse import Warehouse
from shopstar.session import ensure_checkpoint_dir, scratch_folder, scratch_scope, size_tasks
from shopstar.sources import planted as P
from shopstar.sources.store import CachedStore, Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_named_order_columns_are_shuffled_once(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    assert "__k0" not in plan(place_rows(df, ["k", "id"]))
    assert "__k0" in plan(place_rows(df, [-F.col("k"), "id"]))


def test_rare_repeats_give_the_rows_of_dedupe_first(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "c"), (None, "z"), (None, "x"), (4, "d")],
                               "k long, v string")
    for rows in (df, df.union(df), df.where("k = 4")):
        assert sorted(map(str, dedupe_rare(rows, "k").collect())) == sorted(map(str, dedupe_first(rows, "k").collect()))


def test_tables_without_repeats_are_not_shuffled(spark):
    df = spark.range(50).selectExpr("id AS k", "cast(id AS string) AS v")
    assert "Exchange" not in plan(dedupe_rare(df, "k"))


def test_a_cached_fact_is_neither_laid_out_nor_copied(spark):
    df = spark.range(10).selectExpr("id", "20240101 AS day")
    fact = CachedStore().put("f", df, ("month", "day"), "id")
    assert "Exchange" not in plan(fact) and not fact.is_cached


def test_number_keys_are_compared_as_numbers(spark):
    child = spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (None, None, None)], "a int, b long, c string")
    parent = spark.createDataFrame([(1, "a")], "id long, name string")
    out = orphan_rule_rows("x", child, [("a", "a", parent, "id"), ("b?", "b", parent, "id"), ("c", "c", parent, "name")])
    assert {r.check_name: r.observed for r in out.collect()} == {"a": 2, "b": 1, "c": 2}
    assert not re.search(r"cast\([ab]#\d+L? as string\)", plan(out))
    twice = duplicate_rule_rows("x", [("a", child.union(child), "a"), ("c", child, "c")])
    assert {r.check_name: r.observed for r in twice.collect()} == {"a": 4, "c": 1}


def test_partitions_follow_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size_tasks(spark, 4000 << 20)
    assert spark.conf.get(key) == "1000"
    size_tasks(spark, 0)
    assert spark.conf.get(key) == spark.conf.get("spark.sql.shuffle.partitions")


def test_the_checkpoint_folder_is_made_once(spark):
    folder, own = ensure_checkpoint_dir(spark), spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == folder and spark.sparkContext.getCheckpointDir() == own
    assert scratch_folder(spark, "t").startswith(f"{folder.rstrip('/')}/t-")


def test_columns_that_only_order_are_not_written(spark):
    df = spark.createDataFrame([(2, "x", 5), (1, "y", 6), (1, "x", 7)], "a int, b string, c int")
    out = global_order(df, ["a", "b"], "n", keep=["c"])
    assert out.columns == ["c", "n"] and {r.n: r.c for r in out.collect()} == {1: 7, 2: 6, 3: 5}
    assert not {"a", "b"} & set(spark.read.parquet(*out.inputFiles()).columns)


@pytest.fixture()
def tiny(spark):
    """Staging and dimensions with unmatched, missing and repeated keys."""
    stg = {
        "stg_orders": spark.sql("""SELECT CAST(a AS long) order_id, CAST(b AS long) customer_id, CAST(c AS long) channel_id,
            CAST(d AS long) promotion_id, TIMESTAMP_NTZ'2024-01-05 00:00:00' order_date
            FROM VALUES (1, 1, 1, 1), (2, 1, 2, NULL), (3, -1, 1, 1), (4, 1, 99, 1), (5, NULL, 1, 1), (6, 2, 1, 999) v(a, b, c, d)"""),
        "stg_payments": spark.sql("""SELECT CAST(a AS long) payment_id, CAST(b AS long) order_id, c payment_method
            FROM VALUES (9, 1, 'cash'), (8, 1, 'card'), (7, 6, NULL) v(a, b, c)"""),
        "stg_order_items": spark.sql("""SELECT CAST(a AS long) order_item_id, CAST(b AS long) order_id, c product_id, 2 quantity,
            CAST(3 AS decimal(10,2)) unit_price, CAST(0 AS decimal(10,2)) discount_amount, CAST(6 AS decimal(12,2)) line_total
            FROM VALUES (1, 1, 'P1'), (2, 1, 'PX'), (3, 2, 'P1'), (4, 3, 'P1'), (5, 4, 'P1'), (6, 5, 'P1'), (7, 6, 'P2'),
            (8, NULL, 'P1'), (9, 77, 'P1'), (10, 6, NULL) v(a, b, c)"""),
    }
    dims = {
        "dim_customer": spark.sql("SELECT 11L customer_key, 1L customer_id UNION ALL SELECT 12L, 2L UNION ALL SELECT 13L, 2L"),
        "dim_channel": spark.sql("SELECT 21L channel_key, 1L channel_id UNION ALL SELECT 22L, 2L"),
        "dim_product": spark.sql("SELECT 31L product_key, 'P1' product_id, 41L category_key UNION ALL SELECT 32L, 'P2', 42L"),
        "dim_promotion": spark.sql("SELECT 1L promotion_key, CAST(NULL AS long) promotion_id UNION ALL SELECT 2L, 1L"),
        "dim_payment_method": spark.sql("SELECT 0L payment_method_key, 'UNKNOWN' payment_method UNION ALL SELECT 1L, 'card'"),
    }
    return stg, dims


def test_lines_without_a_match_are_dropped_and_repeats_multiply(tiny):
    got = sorted((r.order_item_id, r.customer_key, r.product_key, r.category_key, r.channel_key, r.promotion_key,
                  r.payment_method_key, r.order_date_key, float(r.gross_revenue)) for r in star_module.fact_sales(*tiny).collect())
    assert got == [(1, 11, 31, 41, 21, 2, 1, 20240105, 6.0), (3, 11, 31, 41, 22, 1, 0, 20240105, 6.0),
                   (7, 12, 32, 42, 21, 1, 0, 20240105, 6.0), (7, 13, 32, 42, 21, 1, 0, 20240105, 6.0)]


def test_lines_are_not_shuffled_by_what_their_order_says(spark, tiny, monkeypatch):
    made = []
    monkeypatch.setattr(star_module, "dense_key", lambda df, *a, **k: made.append(df) or df.withColumn("sales_key", F.lit(1)))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        star_module.fact_sales(*tiny)
        lines = plan(made[0]).splitlines()
    finally:
        spark.conf.set(key, before)
    found = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning(customer_id" in line]
    assert found and not [x for x in found if "line_total" in x]


def test_a_fact_over_other_staging_needs_no_clean_fact(spark, small_warehouse, monkeypatch):
    def star(self):
        raise AssertionError("the clean facts are built")

    monkeypatch.setattr(Warehouse, "star", property(star))
    for name in ("b11_fact_sales_dangling", "dq_cross_layer_planted"):
        assert not catalog.queries()[name](spark, small_warehouse.sf_dir).isEmpty()


def test_sketches_are_filled_once_per_group(spark, monkeypatch):
    fact = spark.range(3000).selectExpr(
        "cast(20240101 + id % 28 AS int) order_date_key", "nullif(id % 11, 0) category_key", "id % 3 channel_key",
        "id div 4 order_id", "id % 77 customer_key", "2 quantity",
        *[f"cast(id AS decimal(12,2)) {c}" for c in ("gross_revenue", "discount_amount", "net_revenue")])
    plans = []
    monkeypatch.setattr("shopstar.plans.sketches.written", lambda df, name: plans.append(plan(df)) or df)
    before = spark.conf.get("spark.sql.execution.replaceHashWithSortAgg")
    out = stored_sketches({"fact_sales": fact})
    assert plans[0].count("hll_sketch_agg(order_id") == 1 and "merge" not in plans[0] and plans[0].count("Exchange") == 1
    assert spark.conf.get("spark.sql.execution.replaceHashWithSortAgg") == before
    keys = ["order_date_key", "category_key", "channel_key"]
    want = fact.groupBy(*keys).agg(F.count_distinct("order_id").alias("o"), F.count_distinct("customer_key").alias("c"),
                                   F.sum("net_revenue").alias("n"), F.sum("quantity").alias("u"))
    got = out.select(*keys, F.hll_sketch_estimate("orders"), F.hll_sketch_estimate("customers"), "net_revenue", "units_sold")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_a_question_builds_only_what_it_reads(spark, monkeypatch):
    """b5_dim_category reads products: neither orders nor lines are numbered, shuffled or written for it."""
    def unread(*_):
        raise AssertionError("a table is built that the question does not read")

    for name in ("orders", "order_lines", "customer_addresses"):
        monkeypatch.setattr(f"shopstar.sources.fixture.{name}", unread)
    wh = Warehouse(spark, "/root/testdata/sf0.001", CachedStore())
    assert wh.star["dim_category"].count() > 0 and set(wh.star) >= {"fact_sales", "fact_returns", "dim_date"}
    monkeypatch.setattr(star_module, "fact_returns", unread)
    monkeypatch.setattr("shopstar.plans.warehouse.warehouse", lambda *_: wh)
    assert P.planted(wh.star, P.STAR)["dim_category"].count() > wh.star["dim_category"].count()


def test_tables_of_a_session_fill_no_memory_and_outlive_scopes(spark):
    kept = Tables({"t": lambda: CachedStore().put("t", spark.range(5))})
    with scratch_scope(spark):
        assert not kept["t"].is_cached
    assert kept["t"].count() == 5 and kept["t"] is kept["t"]


def test_tables_without_repeats_are_views(spark, monkeypatch):
    monkeypatch.setattr(CachedStore, "put", lambda *_: pytest.fail("a second copy is written"))
    rows = spark.range(9).selectExpr("id payment_id", "id order_id", "' x ' payment_method", "1 amount", "id payment_date", "'s' status")
    assert stage_on_demand({"payments": rows}, CachedStore())["stg_payments"].first().payment_method == "x"


def test_shuffle_files_go_with_their_job(spark):
    size_tasks(spark, 0)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_rows_in_ranges_are_numbered_as_one(spark, n):
    df = spark.range(6000).selectExpr("nullif(id div 2 % 2500, 7) k", "id v", "id % 5 b")
    parts = ranges(df, "k", n, "b")
    assert sum(rows.count() for rows, *_ in parts) == 6000 and (len(parts) > 1 or n == 1)
    assert all(rows.agg(F.min("b"), F.max("b")).first() == (low, high) for rows, low, high in parts)
    want = global_order(df, ["k", "v"], "rank")
    got = global_order(parts[0][0], ["k", "v"], "rank", parts=[rows for rows, *_ in parts[1:]])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    nothing = ranges(df.where("false"), "k", n, "b")
    assert [(rows.count(), low, high) for rows, low, high in nothing] == [(0, None, None)]


def test_a_fact_in_slices_is_the_fact(spark, tiny, monkeypatch):
    stg, dims = tiny
    many = stg["stg_order_items"].crossJoin(spark.range(400).withColumnRenamed("id", "k"))
    many = many.withColumn("order_item_id", F.col("order_item_id") + 10 * F.col("k")).drop("k")
    stg = {**stg, "stg_order_items": many.unionByName(stg["stg_order_items"].withColumn("order_item_id", F.lit(None).cast("long")))}
    whole = star_module.fact_sales(stg, dims)
    written = []
    real = star_module.dense_key
    monkeypatch.setattr(star_module, "dense_key", lambda *a: written.append(len(a) - 3) or real(*a))
    monkeypatch.setattr(star_module, "SLICE_BYTES", 10)
    sliced = star_module.fact_sales(stg, dims, 40)
    assert written == [4] and sliced.count() == whole.count() > 1600
    assert sorted(r.sales_key for r in sliced.collect()) == list(range(1, whole.count() + 1))
    assert sliced.drop("sales_key").exceptAll(whole.drop("sales_key")).isEmpty()
    known = F.col("order_item_id").isNotNull()  # rows with one id may be numbered either way
    pairs = [f.where(known).select("order_item_id", "sales_key", "product_key").distinct().count() for f in (sliced, whole)]
    assert pairs[0] == pairs[1]
