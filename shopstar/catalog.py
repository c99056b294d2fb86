"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator
family of the inventory. Every one reads the test tables through the cached
warehouse (sources -> staging -> star), so its work grows with them.

Dates and timestamps are rendered as text at this edge (as an API would),
money as doubles; everything else keeps its type.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstar.functions.filters import QueryFilters
from shopstar.operators.interval_join import interval_join
from shopstar.operators.ordering import global_order, segmented_exclusive_sum
from shopstar.plans import analytics as A
from shopstar.plans import quality as Q
from shopstar.plans.attributes import attribute_counts
from shopstar.plans.guarded_sql import guarded_sql
from shopstar.plans.pricing import price_order_lines, price_returns
from shopstar.plans.staging import stage_table
from shopstar.plans.sketches import sketch_errors, stored_sketches
from shopstar.plans.star import fact_sales
from shopstar.plans.upsert import upsert
from shopstar.plans.warehouse import warehouse
from shopstar.sources import planted as P
from shopstar.sources.io import read_sql
from shopstar.sources.planted import planted

Query = Callable[[SparkSession, str], DataFrame]

# The slice used by every ``*_filtered`` query: all three filters at once.
SLICE = QueryFilters(start_date=dt.date(1996, 1, 1), end_date=dt.date(1999, 12, 31),
                     categories=("ECONOMY", "STANDARD"), channels=("URGENT", "HIGH", "LOW"))


def edge(df: DataFrame) -> DataFrame:
    """Render dates as ``yyyy-MM-dd`` and timestamps as ``yyyy-MM-dd
    HH:mm:ss`` text, decimals as doubles."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _star(spark: SparkSession, d: str):
    return warehouse(spark, d).star


def _staged(name: str) -> Query:
    return lambda spark, d: edge(warehouse(spark, d).staged[name])


def _table(name: str) -> Query:
    return lambda spark, d: edge(_star(spark, d)[name])


def _over_staged(fn) -> Query:
    return lambda spark, d: fn(warehouse(spark, d).staged)


def _an(fn, **kw) -> Query:
    return lambda spark, d: fn(_star(spark, d), **kw)


def _order_lines(spark: SparkSession, d: str) -> DataFrame:
    src = warehouse(spark, d).staged
    return edge(price_order_lines(src["stg_order_items"], src["stg_orders"],
                                  src["stg_promotions"]))


def price_staged_returns(stg: dict[str, DataFrame]) -> DataFrame:
    """Staged returns priced anew from their staged lines (N22): 30 days after
    the order, at most the last order day."""
    window = stg["stg_orders"].agg(F.max(F.to_date("order_date")).alias("window_end"))  # one row
    lines = stg["stg_order_items"].select("order_item_id", "order_id", "quantity", "line_total")
    returned = (stg["stg_returns"].select("return_id", "order_item_id",
                                          F.col("quantity").alias("quantity_returned"))
                .join(lines, "order_item_id")
                .join(stg["stg_orders"].select("order_id", "order_date"), "order_id")
                .withColumn("days_after", F.lit(30)).crossJoin(F.broadcast(window)))
    priced = price_returns(returned, "window_end")
    return edge(priced.select("return_id", "order_item_id", "refund_amount", "return_date"))


def _billing(spark: SparkSession, d: str) -> DataFrame:
    """Parameterised SELECT over a source table."""
    return read_sql(spark, "SELECT customer_id, city, state, country FROM {addresses} WHERE address_type = :kind",
                    {"kind": "billing"}, addresses=warehouse(spark, d).sources["customer_addresses"])


def _latest_order(spark: SparkSession, d: str) -> DataFrame:
    """The newest row of a table (K3): a top-1, combined per task."""
    o = warehouse(spark, d).staged["stg_orders"]
    return edge(o.orderBy(F.desc("order_date"), F.desc("order_id")).limit(1).select("order_id", "order_date"))


def _never_returned(spark: SparkSession, d: str) -> DataFrame:
    """Set difference (U3): staged products without a returned line."""
    stg = warehouse(spark, d).staged
    back = stg["stg_order_items"].join(stg["stg_returns"].select("order_item_id"), "order_item_id", "left_semi")
    return stg["stg_products"].select("product_id").join(
        back.select("product_id").distinct(), "product_id", "left_anti")


def _dangling(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return planted(warehouse(spark, d).staged, P.DANGLING)


def _dangling_sales(spark: SparkSession, d: str) -> DataFrame:
    return fact_sales(_dangling(spark, d), warehouse(spark, d).dimensions)


def _fact_dangling(spark: SparkSession, d: str) -> DataFrame:
    """The sales fact over staging with unmatched keys."""
    return edge(_dangling_sales(spark, d))


def _repeated(name: str) -> Query:
    """A staged table over a source with repeated keys (P5)."""
    return lambda spark, d: edge(stage_table(planted(warehouse(spark, d).sources, P.REPEATED), name))


def active_promotions(stg: dict[str, DataFrame]) -> DataFrame:
    """Every promotion active on each order's day (J12), not only the lowest."""
    return interval_join(stg["stg_orders"].select("order_id", "order_date"), "order_date",
                         stg["stg_promotions"], "start_date", "end_date", "promotion_id") \
        .select("order_id", "promotion_id")


def orders_in_open_windows(stg: dict[str, DataFrame]) -> DataFrame:
    """Orders and revenue in long and open windows (J12): of four promotions
    one has no end, one no start, one lasts a hundred years."""
    kind = F.col("promotion_id") % 4
    windows = stg["stg_promotions"].select(
        "promotion_id", F.when(kind != 1, F.col("start_date")).alias("since"),
        F.when(kind == 2, F.add_months("start_date", 1200)).when(kind != 0, F.col("end_date")).alias("until"))
    met = interval_join(stg["stg_orders"].select("order_id", "order_date", "total_amount"), "order_date",
                        windows, "since", "until", "promotion_id")
    return edge(met.groupBy("promotion_id").agg(
        F.count("*").alias("orders"), F.sum("total_amount").cast("decimal(22,2)").alias("total_amount"),
        F.min("order_id").alias("first_order"), F.max("order_date").alias("last_at")))


def ranked_lines(star: dict[str, DataFrame]) -> DataFrame:
    """Global rank and running revenue of all sales lines."""
    f = star["fact_sales"].select(
        "order_item_id", F.col("net_revenue").alias("net"))
    ranked = global_order(f, [-F.col("net"), F.col("order_item_id")], "rank",
                          running_sums={"running_net": "net"})
    return edge(ranked.select("rank", "order_item_id", "net", "running_net"))


def running_sums(star: dict[str, DataFrame]) -> DataFrame:
    """Per-order exclusive running sum of line revenue, segments of 2 ids."""
    f = star["fact_sales"].select("order_id", "order_item_id", "net_revenue")
    out = segmented_exclusive_sum(f, ["order_id"], "order_item_id", "net_revenue",
                                  "net_before", bucket_width=2)
    return edge(out.select("order_id", "order_item_id", "net_revenue", "net_before"))


def _upsert(spark: SparkSession, d: str) -> DataFrame:
    """Keyed upsert (S13): the staged channels upserted with a change row per
    channel, re-keyed to twice its id, so ids that already exist are updated
    and the rest are inserted."""
    ch = warehouse(spark, d).staged["stg_sales_channels"]
    changes = ch.select(
        (F.col("channel_id") * F.lit(2)).alias("channel_id"),
        F.concat(F.lit("NEW "), F.col("channel_name")).alias("channel_name"),
        F.lit("partner").alias("channel_type"))
    return upsert(ch, changes, ["channel_id"])


def moved_customers(stg: dict[str, DataFrame]) -> DataFrame:
    """Keyed upsert (S13) at fact-like size: every staged customer yields a
    change row keyed by twice its id (a moved address), so about half the
    keys update and half insert. Both sides are whole tables."""
    cu = stg["stg_customers"]
    changes = cu.select(*[
        (F.col(c) * F.lit(2)).alias(c) if c == "customer_id"
        else F.concat(F.lit("MOVED "), F.col(c)).alias(c) if c == "city"
        else F.col(c) for c in cu.columns])
    return edge(upsert(cu, changes, ["customer_id"]))


GUARDED_SQL = """
WITH sold AS (SELECT category_key, order_id, net_revenue FROM fact_sales WHERE quantity > 0)
SELECT parent_category, count(DISTINCT order_id) AS orders, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue
FROM dim_category JOIN sold ON sold.category_key = dim_category.category_key
GROUP BY parent_category
"""


CAPPED_SQL = ("SELECT order_item_id, CAST(net_revenue AS DOUBLE) AS net_revenue FROM fact_sales "
              "ORDER BY fact_sales.net_revenue DESC, order_item_id")


def _guarded(spark: SparkSession, d: str) -> DataFrame:
    return guarded_sql(spark, GUARDED_SQL, _star(spark, d))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in ("sales_channels", "promotions", "customer_addresses", "orders",
                 "order_items", "payments", "returns"):
        q[f"b1_stg_{name}"] = _staged(f"stg_{name}")
    q["b2_stg_customers"] = _staged("stg_customers")
    q["b3_stg_products"] = _staged("stg_products")
    for i, name in enumerate(("dim_customer", "dim_category", "dim_product", "dim_channel",
                              "dim_promotion", "dim_payment_method", "dim_date",
                              "fact_sales", "fact_returns"), start=4):
        q[f"b{i}_{name}"] = _table(name)
    q["n1_date_bounds"] = _an(A.filter_date_bounds)
    q["n1_categories"] = _an(A.filter_categories)
    q["n1_channels"] = _an(A.filter_channels)
    plain_and_sliced = {
        "n2_kpi_summary": A.kpi_summary,
        "n3_revenue_by_category": A.revenue_by_category,
        "n4_revenue_by_product": A.revenue_by_product,
        "n5_sales_trend_month": A.sales_trend,
        "n6_category_trend": A.category_trend,
        "n7_customer_segments": A.customer_segments,
        "n8_repeat_vs_one_time": A.repeat_vs_one_time,
        "n9_top_customers": A.top_customers,
        "n10_concentration_product": A.revenue_concentration,
        "n11_clv_distribution": A.clv_distribution,
        "n12_channel_performance": A.channel_performance,
        "n13_channel_product_matrix": A.channel_product_matrix,
        "n14_promotion_performance": A.promotion_performance,
    }
    for name, fn in plain_and_sliced.items():
        q[name] = _an(fn)
        q[f"{name}_filtered"] = _an(fn, filters=SLICE)
    q["n2_kpi_summary_empty"] = _an(A.kpi_summary, filters=QueryFilters(
        start_date=dt.date(2030, 1, 1)))
    q["n4_revenue_by_product_1000"] = _an(A.revenue_by_product, limit=1000)
    q["n5_sales_trend_day"] = _an(A.sales_trend, granularity="day")
    q["n9_top_customers_5"] = _an(A.top_customers, limit=5)
    q["n10_concentration_customer"] = _an(A.revenue_concentration, entity="customer")
    q["n13_channel_product_matrix_50"] = _an(A.channel_product_matrix, limit=50)
    q["n16_promo_vs_baseline"] = _an(A.promo_vs_baseline)
    q["n17_clv_histogram"] = _an(A.clv_histogram)
    q["n18_gross_net_long"] = _an(A.gross_net_long)
    q["n19_top_products_by_quantity"] = _an(A.top_products_by_quantity)
    q["n20_pareto_threshold_product"] = _an(A.pareto_threshold)
    q["n20_pareto_threshold_customer"] = _an(A.pareto_threshold, entity="customer")
    q["n21_price_order_lines"] = _order_lines
    q["n22_price_returns"] = _over_staged(price_staged_returns)
    q["j12_interval_join"] = _over_staged(active_promotions)
    q["j12_open_windows"] = _over_staged(orders_in_open_windows)
    q["a2_sketched_counts"] = _an(lambda star: sketch_errors(star, stored_sketches(star)))
    q["p6_attribute_counts"] = _over_staged(lambda stg: attribute_counts(stg["stg_products"]))
    q["w1_w2_bucketed_rank"] = _an(ranked_lines)
    q["w6_segmented_running_sum"] = _an(running_sums)
    q["s13_upsert_channels"] = _upsert
    q["s13_upsert_customers"] = _over_staged(moved_customers)
    q["dq_staging_gate"] = lambda spark, d: Q.staging_checks(warehouse(spark, d).staged)
    q["dq_analytics_gate"] = lambda spark, d: Q.analytics_checks(
        _star(spark, d), as_of=dt.date(2002, 1, 1))
    q["dq_staging_suite"] = lambda spark, d: Q.staging_suite(warehouse(spark, d).staged)
    q["dq_star_suite"] = lambda spark, d: Q.star_suite(_star(spark, d))
    q["dq_cross_layer"] = lambda spark, d: Q.cross_layer_checks(
        warehouse(spark, d).staged, _star(spark, d))
    q["dq_staging_gate_planted"] = lambda spark, d: Q.staging_checks(
        planted(warehouse(spark, d).staged, P.STAGING))
    q["dq_staging_suite_planted"] = lambda spark, d: Q.staging_suite(
        planted(warehouse(spark, d).staged, P.STAGING))
    q["dq_analytics_gate_planted"] = lambda spark, d: Q.analytics_checks(
        planted(_star(spark, d), P.STAR), as_of=dt.date(2002, 1, 1))
    q["dq_star_suite_planted"] = lambda spark, d: Q.star_suite(planted(_star(spark, d), P.STAR))
    q["dq_cross_layer_planted"] = lambda spark, d: Q.cross_layer_checks(
        _dangling(spark, d), {"fact_sales": _dangling_sales(spark, d)})
    q["b11_fact_sales_dangling"] = _fact_dangling
    for name in P.REPEATED:
        q[f"b1_stg_{name}_repeated"] = _repeated(name)
    q["s4_billing_addresses"] = _billing
    q["k3_latest_order"] = _latest_order
    q["u3_products_never_returned"] = _never_returned
    q["g5_capped_rows"] = lambda spark, d: guarded_sql(spark, CAPPED_SQL, _star(spark, d), max_rows=100)
    q["g_guarded_sql"] = _guarded
    return q
