"""Business questions over the star.

Each function takes the star tables (``dict[name, DataFrame]``) and an
optional :class:`QueryFilters` and returns a DataFrame; the caller picks the
action. Shape rules used throughout:

* aggregate the fact on its surrogate key first, then join the (much
  smaller) result to the dimension: the fact is shuffled once, partially
  aggregated map-side, and never widened by dimension columns;
* distinct orders per group are counted on the fact key when an order has
  exactly one value of that key (date, customer, channel, promotion), so the
  per-key counts add up exactly over the dimension's grouping;
* money is summed as decimals and turned into doubles only in the final
  projection; averages and percentages are rounded half-up on integers;
* every top-k and rank has a unique last sort key.
"""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstar.functions.filters import EVERYTHING, QueryFilters
from shopstar.functions.money import cents, half_up_ratio, idiv
from shopstar.operators.ordering import global_order
from shopstar.operators.selection import rank_reaching
from shopstar.sources.store import written

Star = dict[str, DataFrame]


def _money(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


def _rows(limit: int) -> int:
    """The rows a top-k asks for, as asked: there is no silent ceiling."""
    if limit < 1:
        raise ValueError(f"limit must be 1 or more, not {limit}")
    return limit


def _day_text(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


# ------------------------------------------------------------------ N1
def filter_date_bounds(star: Star) -> DataFrame:
    """First and last order day with sales."""
    ends = star["fact_sales"].agg(F.min("order_date_key").alias("lo"),
                                  F.max("order_date_key").alias("hi"))  # one row, no distinct shuffle
    d = star["dim_date"].join(F.broadcast(ends), F.col("date_key").between(F.col("lo"), F.col("hi")))
    return d.agg(_day_text(F.min("full_date")).alias("min_date"),
                 _day_text(F.max("full_date")).alias("max_date"))


def filter_categories(star: Star) -> DataFrame:
    return star["dim_category"].select("parent_category").distinct().orderBy("parent_category")


def filter_channels(star: Star) -> DataFrame:
    return star["dim_channel"].select("channel_name").orderBy("channel_name")


# ------------------------------------------------------------------ N2
def kpi_summary(star: Star, filters: QueryFilters = EVERYTHING,
                approx_distinct: bool = False) -> DataFrame:
    """Headline KPIs; one row even when the slice is empty (N2). Refunds are
    an independent total over returns in the slice (by return date).

    ``approx_distinct`` counts orders and customers with HyperLogLog++ (about
    1 % error, no distinct shuffle) for dashboards; exact by default."""
    f = filters.sales(star)
    measures = {"gross_revenue": "gross_revenue", "total_discounts": "discount_amount",
                "net_revenue": "net_revenue", "units_sold": "quantity"}
    if approx_distinct:
        sales = f.agg(F.approx_count_distinct("order_id", 0.01).alias("orders"),
                      F.approx_count_distinct("customer_key", 0.01).alias("customers"),
                      *[F.sum(c).alias(n) for n, c in measures.items()])
    else:  # an order has one customer: count up the grains, no Expand of the fact
        sums = [F.sum(n).alias(n) for n in measures]
        per_order = f.groupBy("customer_key", "order_id").agg(
            *[F.sum(c).alias(n) for n, c in measures.items()])
        per_customer = per_order.groupBy("customer_key").agg(F.count(F.lit(1)).alias("orders"), *sums)
        sales = per_customer.agg(F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
                                 F.count(F.lit(1)).alias("customers"), *sums)
    sales = sales.withColumn("units_sold", F.col("units_sold").cast("long"))
    refunds = filters.returns(star).agg(
        F.coalesce(F.sum("refund_amount"), F.lit(0)).alias("refunds"))
    return sales.crossJoin(F.broadcast(refunds)).select(  # both sides are one row
        "orders", "customers", _money("gross_revenue"), _money("total_discounts"),
        _money("net_revenue"), "units_sold", _money("refunds"))


# ------------------------------------------------------------------ N3
def revenue_by_category(star: Star, filters: QueryFilters = EVERYTHING) -> DataFrame:
    per_key = filters.sales(star).groupBy("category_key").agg(
        F.sum("gross_revenue").alias("g"), F.sum("discount_amount").alias("d"),
        F.sum("net_revenue").alias("n"), F.sum("quantity").alias("q"))
    out = (per_key.join(star["dim_category"], "category_key")
           .groupBy("parent_category", "category_name")
           .agg(F.sum("g").alias("gross_revenue"), F.sum("d").alias("discounts"),
                F.sum("n").alias("net_revenue"), F.sum("q").cast("long").alias("quantity_sold")))
    return out.orderBy(F.desc("net_revenue"), "parent_category", "category_name").select(
        "parent_category", "category_name", _money("gross_revenue"), _money("discounts"),
        _money("net_revenue"), "quantity_sold")


# ------------------------------------------------------------------ N4
def revenue_by_product(star: Star, limit: int = 20,
                       filters: QueryFilters = EVERYTHING) -> DataFrame:
    """Top products by net revenue, grouped on name/brand/category name, so
    same-named products merge (N4). ``limit`` is the k of the top-k."""
    per_key = filters.sales(star).groupBy("product_key").agg(
        F.sum("net_revenue").alias("n"), F.sum("gross_revenue").alias("g"),
        F.sum("quantity").alias("q"))
    out = (per_key.join(star["dim_product"], "product_key")
           .groupBy("product_name", "brand", "category_name")
           .agg(F.sum("n").alias("net_revenue"), F.sum("g").alias("gross_revenue"),
                F.sum("q").cast("long").alias("quantity_sold")))
    top = out.orderBy(F.desc("net_revenue"), F.asc_nulls_first("product_name"),
                      F.asc_nulls_first("brand"), F.asc_nulls_first("category_name")) \
        .limit(_rows(limit))  # top-k is the feature: TakeOrderedAndProject
    return top.select("product_name", "brand", "category_name", _money("net_revenue"),
                      _money("gross_revenue"), "quantity_sold")


# ------------------------------------------------------------------ N5
def sales_trend(star: Star, granularity: str = "month",
                filters: QueryFilters = EVERYTHING) -> DataFrame:
    """Revenue, quantity and orders per day, or per month for any other
    granularity (N5)."""
    per_day = filters.sales(star).groupBy("order_date_key").agg(
        F.sum("net_revenue").alias("n"), F.sum("gross_revenue").alias("g"),
        F.sum("quantity").alias("q"), F.count_distinct("order_id").alias("o"))
    dd = star["dim_date"]
    j = per_day.join(dd, per_day.order_date_key == dd.date_key)
    period = F.col("full_date") if granularity == "day" else F.trunc("full_date", "month")
    out = j.groupBy(period.alias("p")).agg(
        F.sum("n").alias("net_revenue"), F.sum("g").alias("gross_revenue"),
        F.sum("q").cast("long").alias("quantity_sold"), F.sum("o").cast("long").alias("orders"))
    return out.orderBy("p").select(_day_text(F.col("p")).alias("period"), _money("net_revenue"),
                                   _money("gross_revenue"), "quantity_sold", "orders")


# ------------------------------------------------------------------ N6
def category_trend(star: Star, filters: QueryFilters = EVERYTHING) -> DataFrame:
    per = filters.sales(star).groupBy("order_date_key", "category_key").agg(
        F.sum("net_revenue").alias("n"))
    dd = star["dim_date"]
    j = (per.join(dd, per.order_date_key == dd.date_key)
         .join(star["dim_category"], "category_key"))
    out = j.groupBy(F.trunc("full_date", "month").alias("p"), "parent_category").agg(
        F.sum("n").alias("net_revenue"))
    return out.orderBy("p", "parent_category").select(
        _day_text(F.col("p")).alias("period"), "parent_category", _money("net_revenue"))


# ------------------------------------------------------------------ N7 / N8 / N11
def _per_customer(star: Star, filters: QueryFilters) -> DataFrame:
    return filters.sales(star).groupBy("customer_key").agg(
        F.sum("net_revenue").alias("total_spend"),
        F.count_distinct("order_id").alias("orders"))


# Spending tiers (lower bound of net spend, label), highest first
SPENDING_TIERS = [(5000, "VIP (5k+)"), (1000, "High (1k-5k)"), (250, "Mid (250-1k)")]
LOWEST_TIER = "Low (<250)"


def customer_segments(star: Star, filters: QueryFilters = EVERYTHING) -> DataFrame:
    spend = _per_customer(star, filters)
    tier = F.lit(LOWEST_TIER)
    for bound, label in reversed(SPENDING_TIERS):
        tier = F.when(F.col("total_spend") >= bound, label).otherwise(tier)
    out = spend.groupBy(tier.alias("spending_tier")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_spend").alias("net_revenue"))
    return out.orderBy(F.desc("net_revenue"), "spending_tier").select(
        "spending_tier", "customers", _money("net_revenue"))


def repeat_vs_one_time(star: Star, filters: QueryFilters = EVERYTHING) -> DataFrame:
    per = _per_customer(star, filters)
    kind = F.when(F.col("orders") > 1, "Repeat buyers").otherwise("One-time buyers")
    out = per.groupBy(kind.alias("buyer_type")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_spend").alias("net_revenue"),
        F.sum("orders").alias("__orders"))
    return out.orderBy("buyer_type").select(
        "buyer_type", "customers", _money("net_revenue"),
        half_up_ratio(F.col("__orders"), F.col("customers")).alias("avg_orders"))


def clv_distribution(star: Star, filters: QueryFilters = EVERYTHING) -> DataFrame:
    per = filters.sales(star).groupBy("customer_key").agg(
        F.sum("net_revenue").alias("lifetime_value"))
    return per.orderBy(F.desc("lifetime_value"), "customer_key").select(
        "customer_key", _money("lifetime_value"))


# ------------------------------------------------------------------ N9
def top_customers(star: Star, limit: int = 20, filters: QueryFilters = EVERYTHING) -> DataFrame:
    per = _per_customer(star, filters)
    out = (per.join(star["dim_customer"], "customer_key")
           .groupBy("full_name", "country")
           .agg(F.sum("orders").cast("long").alias("orders"),
                F.sum("total_spend").alias("lifetime_value")))
    top = out.orderBy(F.desc("lifetime_value"), F.asc_nulls_first("full_name"),
                      F.asc_nulls_first("country")).limit(_rows(limit))
    return top.select("full_name", "country", "orders", _money("lifetime_value"))


# ------------------------------------------------------------------ N10 / N20
def revenue_concentration(star: Star, entity: str = "product",
                          filters: QueryFilters = EVERYTHING) -> DataFrame:
    """Pareto curve: entities ranked by net revenue (ties by key), with the
    share of entities and the cumulative share of revenue (N10). The global
    rank and running sum need no one-task window. The ordering writes the
    per-entity totals once; the grand totals read that table too."""
    key = {"customer": "customer_key"}.get(entity, "product_key")
    ranked = filters.sales(star).groupBy(key).agg(F.sum("net_revenue").alias("net"))
    ranked = ranked.withColumn("net_c", cents(F.col("net")))
    curve = global_order(ranked, [-F.col("net_c"), F.col(key)], "rank",
                         running_sums={"cum_c": "net_c"})
    totals = curve.agg(F.sum("net_c").alias("total_c"), F.count(F.lit(1)).alias("n"))
    return curve.crossJoin(F.broadcast(totals)).select(  # totals: one row
        "rank",
        half_up_ratio(F.col("rank"), F.col("n"), 2, scale=100).alias("entity_pct"),
        half_up_ratio(F.col("cum_c"), F.col("total_c"), 2, scale=100)
        .alias("cumulative_revenue_pct"),
    ).orderBy("rank")


def pareto_threshold(star: Star, entity: str = "product", share: float = 80.0,
                     filters: QueryFilters = EVERYTHING) -> DataFrame:
    """Smallest share of ranked entities reaching ``share`` % of revenue (N20),
    found by weighted selection over the entities' totals: no curve, no sort.
    Without positive revenue no share is reached."""
    key = {"customer": "customer_key"}.get(entity, "product_key")
    spark = star["fact_sales"].sparkSession
    totals = written(filters.sales(star).groupBy(key).agg(F.sum("net_revenue").alias("net"))
                     .select(cents(F.col("net")).alias("net_c")), "entity_totals")
    n, total = totals.agg(F.count("*"), F.coalesce(F.sum("net_c"), F.lit(0))).first()
    # the share of revenue is rounded half up to hundredths of a percent: reached from this sum on
    hundredths = int((Decimal(str(share)) * 100).to_integral_value(ROUND_CEILING))
    target = max(1, -(-int(total) * (2 * hundredths - 1) // 20_000)) if total > 0 else None
    rank = rank_reaching(totals, "net_c", target) if target else None
    return spark.range(1).select(
        F.lit(entity).alias("entity"), F.lit(float(share)).alias("revenue_share"),
        F.lit(rank).cast("long").alias("entities"), F.lit(n).cast("long").alias("n")).select(
        "entity", "revenue_share",
        half_up_ratio(F.col("entities"), F.col("n"), 2, scale=100).alias("entity_pct"), "entities")


# ------------------------------------------------------------------ N12 / N13
def channel_performance(star: Star, filters: QueryFilters = EVERYTHING) -> DataFrame:
    per = filters.sales(star).groupBy("channel_key").agg(
        F.sum("net_revenue").alias("n"), F.sum("quantity").alias("q"),
        F.count_distinct("order_id").alias("o"))
    out = (per.join(star["dim_channel"], "channel_key")
           .groupBy("channel_name", "channel_type")
           .agg(F.sum("n").alias("net_revenue"), F.sum("q").cast("long").alias("quantity_sold"),
                F.sum("o").cast("long").alias("orders")))
    return out.orderBy(F.desc("net_revenue"), "channel_name", "channel_type").select(
        "channel_name", "channel_type", _money("net_revenue"), "quantity_sold", "orders")


def channel_product_matrix(star: Star, limit: int = 5,
                           filters: QueryFilters = EVERYTHING) -> DataFrame:
    """Top ``limit`` products per channel by net revenue (N13). The
    rank filter lets Spark insert a partial per-group limit before the
    window's shuffle, so each channel ships at most ``limit`` rows per task."""
    n = _rows(limit)
    per = filters.sales(star).groupBy("channel_key", "product_key").agg(
        F.sum("net_revenue").alias("n"), F.sum("quantity").alias("q"))
    grouped = (per.join(star["dim_channel"].select("channel_key", "channel_name"), "channel_key")
               .join(star["dim_product"].select("product_key", "product_name"), "product_key")
               .groupBy("channel_name", "product_name")
               .agg(F.sum("n").alias("net_revenue"), F.sum("q").cast("long").alias("quantity_sold")))
    w = Window.partitionBy("channel_name").orderBy(F.desc("net_revenue"),
                                                   F.asc_nulls_first("product_name"))
    ranked = grouped.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return ranked.orderBy("channel_name", "rank").select(
        "channel_name", "product_name", _money("net_revenue"), "quantity_sold",
        F.col("rank").cast("long").alias("rank"))


# ------------------------------------------------------------------ N14 / N16
def _promotion_groups(star: Star, filters: QueryFilters) -> DataFrame:
    per = filters.sales(star).groupBy("promotion_key").agg(
        F.count_distinct("order_id").alias("o"), F.sum("quantity").alias("q"),
        F.count(F.lit(1)).alias("lines"), F.sum("gross_revenue").alias("g"),
        F.sum("discount_amount").alias("d"), F.sum("net_revenue").alias("n"))
    return (per.join(star["dim_promotion"], "promotion_key")
            .groupBy("promotion_code", "discount_type", "discount_value")
            .agg(F.sum("o").cast("long").alias("orders"),
                 F.sum("q").cast("long").alias("quantity_sold"),
                 F.sum("g").alias("gross_revenue"), F.sum("d").alias("discounts"),
                 F.sum("n").alias("net_revenue"), F.sum("lines").alias("lines")))


def promotion_performance(star: Star, filters: QueryFilters = EVERYTHING) -> DataFrame:
    g = _promotion_groups(star, filters)
    return g.orderBy(F.desc("net_revenue"), "promotion_code").select(
        "promotion_code", "discount_type", _money("discount_value"), "orders",
        "quantity_sold", _money("gross_revenue"), _money("discounts"), _money("net_revenue"),
        half_up_ratio(F.col("quantity_sold"), F.col("lines")).alias("avg_items_per_line"))


def promo_vs_baseline(star: Star, filters: QueryFilters = EVERYTHING) -> DataFrame:
    """Promoted orders and discount cost, and the mean over promotions of
    their average items per line against the no-promotion baseline (N16)."""
    g = _promotion_groups(star, filters)
    # the average per promotion, as integer hundredths (exactly 2 places)
    per = g.select(
        "promotion_code", "orders", "discounts",
        idiv(F.col("quantity_sold").cast("decimal(38,0)") * 200 + F.col("lines"),
             F.col("lines") * 2).alias("avg_h"))
    promo = F.col("promotion_code") != "NONE"
    agg = per.agg(
        F.sum(F.when(promo, F.col("orders"))).cast("long").alias("promo_orders"),
        F.sum(F.when(promo, F.col("discounts"))).alias("promo_discounts"),
        F.sum(F.when(promo, F.col("avg_h"))).alias("ph"),
        F.count(F.when(promo, F.lit(1))).alias("pn"),
        F.sum(F.when(~promo, F.col("avg_h"))).alias("bh"),
        F.count(F.when(~promo, F.lit(1))).alias("bn"))
    return agg.select(
        "promo_orders", _money("promo_discounts"),
        half_up_ratio(F.col("ph"), F.col("pn") * 100).alias("avg_items_promo"),
        half_up_ratio(F.col("bh"), F.col("bn") * 100).alias("avg_items_baseline"),
    ).withColumn("avg_items_delta",
                 F.round(F.col("avg_items_promo") * 100 - F.col("avg_items_baseline") * 100)
                 / 100.0)


# ------------------------------------------------------------------ N17 / N18 / N19
def clv_histogram(star: Star, bins: int = 50, filters: QueryFilters = EVERYTHING) -> DataFrame:
    """Customers per equal-width lifetime-value bin between the smallest and
    largest value; the maximum falls in the last bin (N17). Bounds and bins
    read the customers' totals from the same shuffle."""
    per = filters.sales(star).groupBy("customer_key").agg(cents(F.sum("net_revenue")).alias("v"))
    bounds = per.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = F.col("hi") - F.col("lo")
    bucket = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.lit(bins), idiv((F.col("v") - F.col("lo")) * bins, width) + 1))
    b = per.crossJoin(F.broadcast(bounds)).withColumn("bucket", bucket.cast("int"))  # 1 row
    out = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("customers"),
                                  F.min("v").alias("lo_c"), F.max("v").alias("hi_c"))
    return out.orderBy("bucket").select(
        "bucket", "customers", (F.col("lo_c") / 100.0).alias("min_value"),
        (F.col("hi_c") / 100.0).alias("max_value"))


def gross_net_long(star: Star, filters: QueryFilters = EVERYTHING) -> DataFrame:
    """Gross and net revenue per category in long form."""
    wide = revenue_by_category(star, filters).select("category_name", "gross_revenue",
                                                     "net_revenue")
    return wide.unpivot("category_name", ["gross_revenue", "net_revenue"], "measure", "revenue")


def top_products_by_quantity(star: Star, limit: int = 15,
                             filters: QueryFilters = EVERYTHING) -> DataFrame:
    """The top ``limit`` products by revenue, re-sorted by quantity."""
    top = revenue_by_product(star, limit, filters)
    return top.orderBy(F.desc("quantity_sold"), F.desc("net_revenue"),
                       F.asc_nulls_first("product_name"))
