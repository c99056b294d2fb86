"""Source tables in the retail shape, derived by Spark from the TPC-H-ish
test tables (region nation customer part orders lineitem).

The rules are listed in FIXTURES.md section 2; the DuckDB oracle builds the
same tables with the same rules (``oracles/retail.py``). Every table is a
lazy plan over the parquet files, so its work grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.operators.interval_join import lowest_active
from shopstar.operators.ordering import global_order
from shopstar.sources.schemas import PRODUCT_DOCUMENT, SOURCE, conform

# Fixed values (must equal the modelled source system's):
# payment methods, in their declared order
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "apple_pay", "gift_card",
                   "bank_transfer"]
# return reasons, in their declared order
RETURN_REASONS = ["Defective item", "Wrong size", "Not as described", "Changed mind",
                  "Arrived late", "Better price found", "Damaged in transit"]

EPOCH = dt.date(1995, 1, 1)
TPCH_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")


def read_tpch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TPCH_TABLES}


def _pick(names: list[str], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def _cents(x) -> F.Column:
    return F.round(x * 100).cast("long")


def sales_channels(t: dict[str, DataFrame]) -> DataFrame:
    p = t["orders"].select("o_orderpriority").distinct()
    cid = F.substring("o_orderpriority", 1, 1).cast("long")
    return conform(p.select(
        cid.alias("channel_id"),
        F.substring("o_orderpriority", 3, 1000).alias("channel_name"),
        F.when(cid <= 2, "web").when(cid == 3, "mobile").otherwise("marketplace")
        .alias("channel_type")), SOURCE["sales_channels"])


def promotions(t: dict[str, DataFrame]) -> DataFrame:
    n = t["nation"]
    start = F.date_add(F.lit(EPOCH), (F.col("n_nationkey") * 60).cast("int"))
    return conform(n.select(
        (F.col("n_nationkey") + 1).alias("promotion_id"),
        F.concat(F.lit("PROMO"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 3, "0"))
        .alias("promotion_code"),
        F.col("n_name").alias("description"),
        F.when(F.col("n_nationkey") % 10 < 7, "percentage").otherwise("fixed_amount")
        .alias("discount_type"),
        (F.lit(5) * (F.col("n_nationkey") % 6 + 1)).alias("discount_value"),
        start.alias("start_date"),
        F.date_add(start, (F.col("n_nationkey") * 3 + 30).cast("int")).alias("end_date"),
    ), SOURCE["promotions"])


def customers(t: dict[str, DataFrame]) -> DataFrame:
    c = t["customer"]
    return conform(c.select(
        F.col("c_custkey").alias("customer_id"),
        F.split("c_name", "#").getItem(0).alias("first_name"),
        F.split("c_name", "#").getItem(1).alias("last_name"),
        F.concat(F.lit("  "), F.upper(F.replace("c_name", F.lit("#"), F.lit("."))),
                 F.lit("@Example.com ")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.date_sub(F.lit(EPOCH), (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
    ), SOURCE["customers"])


def customer_addresses(t: dict[str, DataFrame]) -> DataFrame:
    geo = (t["customer"].select("c_custkey", "c_nationkey")
           .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
           .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")))
    common = [F.col("c_custkey").alias("customer_id")]
    place = [F.col("n_name").alias("city"),
             F.concat(F.lit("STATE_"), (F.col("c_custkey") % 50).cast("string")).alias("state"),
             F.col("r_name").alias("country"),
             F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("postal_code")]
    billing = geo.where(F.col("c_custkey") % 20 != 0).select(
        (F.col("c_custkey") * 2 + 1).alias("address_id"), *common,
        F.lit("billing").alias("address_type"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Market Street")).alias("street"),
        *place)
    shipping = geo.select(
        (F.col("c_custkey") * 2 + 2).alias("address_id"), *common,
        F.lit("shipping").alias("address_type"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Harbor Road")).alias("street"),
        *place)
    return conform(billing.unionByName(shipping), SOURCE["customer_addresses"])


def product_documents(t: dict[str, DataFrame]) -> DataFrame:
    p = t["part"]
    price = F.col("p_retailprice").cast("decimal(10,2)")
    category = F.concat_ws(" ", "p_type", "p_brand")
    variant = F.struct(F.lit(None).cast("string").alias("sku"), F.lit("black").alias("color"),
                       F.lit("M").alias("size"), F.lit(10).alias("stock"))
    doc = p.select(
        F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("product_id"),
        F.concat(F.lit(" "), F.col("p_name")).alias("name"),
        F.col("p_name").alias("description"),
        F.struct(F.col("p_brand").alias("name")).alias("brand"),
        F.struct(F.when(F.col("p_partkey") % 100 != 0, category).alias("name"),
                 F.col("p_type").alias("parent"),
                 F.concat_ws("/", "p_type", "p_brand").alias("path")).alias("category"),
        F.struct(price.alias("price"),
                 (F.floor(_cents(price) / 2) / 100).cast("decimal(10,2)").alias("cost"),
                 F.lit("USD").alias("currency")).alias("pricing"),
        F.concat(F.lit('{"size": '), F.col("p_size").cast("string"), F.lit("}")).alias("attributes"),
        F.array_repeat(variant, (F.col("p_size") % 4).cast("int")).alias("variants"),
        F.split("p_name", " ").alias("tags"),
        F.struct(F.when(F.col("p_partkey") % 10 != 0, F.lit("2024-01-01T00:00:00+00:00"))
                 .otherwise(F.lit("bad")).alias("created_at"),
                 F.lit("catalog").alias("source")).alias("metadata"),
    )
    return conform(doc, PRODUCT_DOCUMENT)


def line_amounts(li: DataFrame) -> DataFrame:
    """lineitem with each line's quantity, unit price, discount and total."""
    qty = F.col("l_quantity").cast("int")
    unit = (F.floor(_cents(F.col("l_extendedprice")) / qty).cast("long") / 100).cast("decimal(10,2)")
    gross = (unit * qty).cast("decimal(12,2)")
    discount = F.round(gross * F.col("l_discount").cast("decimal(4,2)"), 2).cast("decimal(12,2)")
    return li.withColumns({
        "quantity": qty, "unit_price": unit, "discount_amount": discount,
        "line_total": (gross - discount).cast("decimal(12,2)")})


def orders(t: dict[str, DataFrame]) -> DataFrame:
    o = t["orders"]
    promos = promotions(t)
    with_promo = lowest_active(o, "o_orderdate", promos, "start_date", "end_date",
                               "promotion_id", "__active_promo")
    status = (F.when(F.col("o_orderkey") % 25 == 0, "cancelled")
              .when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "O", "processing")
              .when(F.col("o_orderstatus") == "P", "shipped"))
    totals = line_amounts(t["lineitem"]).groupBy("l_orderkey").agg(F.sum("line_total").alias("__lines"))
    with_totals = with_promo.join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return conform(with_totals.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("channel_id"),
        F.when(F.col("o_orderkey") % 10 < 3, F.col("__active_promo")).alias("promotion_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
        status.alias("status"),
        F.coalesce(F.col("__lines"), F.col("o_totalprice").cast("decimal(12,2)"))
        .alias("total_amount"),
    ), SOURCE["orders"])


LINE_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate"]
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "l_returnflag"]


def order_lines(t: dict[str, DataFrame]) -> DataFrame:
    """Order items plus the lineitem columns the returns rule needs."""
    li = line_amounts(global_order(t["lineitem"], LINE_ORDER, "order_item_id", keep=LINE_COLUMNS))
    return li.select(
        "order_item_id",
        F.col("l_orderkey").alias("order_id"),
        F.concat(F.lit("P"), F.lpad(F.col("l_partkey").cast("string"), 7, "0")).alias("product_id"),
        "quantity", "unit_price", "discount_amount", "line_total",
        "l_returnflag", "l_linenumber",
    )


def order_items(t: dict[str, DataFrame], lines: DataFrame | None = None) -> DataFrame:
    return conform(lines if lines is not None else order_lines(t), SOURCE["order_items"])


def payments(t: dict[str, DataFrame], orders_df: DataFrame | None = None) -> DataFrame:
    o = orders_df if orders_df is not None else orders(t)
    status = F.when(F.col("status") == "cancelled", "refunded").otherwise("completed")
    first = o.where(F.col("order_id") % 50 != 7).select(
        F.col("order_id").alias("payment_id"), "order_id",
        _pick(PAYMENT_METHODS, F.col("order_id") % 6).alias("payment_method"),
        F.col("total_amount").alias("amount"),
        F.col("order_date").alias("payment_date"), status.alias("status"))
    second = o.where(F.col("order_id") % 40 == 3).select(
        (F.col("order_id") + 1_000_000_000).alias("payment_id"), "order_id",
        _pick(PAYMENT_METHODS, (F.col("order_id") + 1) % 6).alias("payment_method"),
        F.col("total_amount").alias("amount"),
        F.col("order_date").alias("payment_date"), status.alias("status"))
    return conform(first.unionByName(second), SOURCE["payments"])


def returns(t: dict[str, DataFrame], lines: DataFrame | None = None,
            orders_df: DataFrame | None = None) -> DataFrame:
    """Returned lines of delivered orders, priced by the pro-rata rule
    (N22); the return date is capped at the last order date of the data."""
    from shopstar.plans.pricing import price_returns

    lines = lines if lines is not None else order_lines(t)
    o = orders_df if orders_df is not None else orders(t)
    window_end = o.agg(F.max(F.to_date("order_date")).alias("__window_end"))
    returned = (lines.where(F.col("l_returnflag") == "R")
                .join(o.where(F.col("status") == "delivered").select("order_id", "order_date"),
                      "order_id")
                .crossJoin(F.broadcast(window_end))  # one row
                .select(
                    F.col("order_item_id").alias("return_id"), "order_id", "order_item_id",
                    "order_date", "quantity", "line_total",
                    (F.floor(F.col("quantity") / 2) + 1).cast("int").alias("quantity_returned"),
                    (F.col("l_linenumber") + 3).alias("days_after"), "__window_end",
                    _pick(RETURN_REASONS, F.col("order_item_id") % 7).alias("reason")))
    priced = price_returns(returned, "__window_end")
    return conform(priced.select(
        "return_id", "order_id", "order_item_id", "return_date",
        F.col("quantity_returned").alias("quantity"), "refund_amount", "reason"),
        SOURCE["returns"])


def load_sources(spark: SparkSession, sf_dir: str, store=None) -> dict[str, DataFrame]:
    """All source tables (8 relational + product documents) for ``sf_dir``.

    With a store, each table is landed there once (the load-sources step);
    orders and the numbered lines are landed first since several source
    tables derive from them. A store that builds on demand lands a table, and
    those it derives from, when it is first asked for."""
    from shopstar.sources.store import LazyStore, Tables

    store = store or LazyStore()
    t = read_tpch(spark, sf_dir)
    base = Tables({"orders": lambda: store.put("src_orders", orders(t)),
                   "lines": lambda: store.view("src_order_lines", order_lines(t))})  # as numbered and written
    found = Tables({
        "sales_channels": lambda: store.view("src_sales_channels", sales_channels(t)),
        "promotions": lambda: store.view("src_promotions", promotions(t)),
        "customers": lambda: store.view("src_customers", customers(t)),
        "customer_addresses": lambda: store.put("src_customer_addresses", customer_addresses(t)),
        "orders": lambda: base["orders"],
        "order_items": lambda: store.view("src_order_items", order_items(t, base["lines"])),
        "payments": lambda: store.view("src_payments", payments(t, base["orders"])),
        "returns": lambda: store.put("src_returns", returns(t, base["lines"], base["orders"])),
        "products": lambda: store.view("src_products", product_documents(t)),
    })
    return found if store.on_demand else dict(found)
