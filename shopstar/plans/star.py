"""Star schema at order-item grain (B4-B12): 7 dimensions, 2 facts.

Surrogate keys are dense from 1 in business-key order (``dense_key``, no
single-partition window at any size). Joins are left to
AQE: a dimension is broadcast when its measured size is under the broadcast
threshold and sort-merge joined (with skew splitting) otherwise; the only
hinted broadcasts are tables with a fixed bound (one-row aggregates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.functions.cleaning import date_key
from shopstar.operators.lookup import left_lookup
from shopstar.operators.ordering import dense_key, ranges
from shopstar.sources.schemas import DIMENSIONS, STAR, conform
from shopstar.sources.store import LazyStore, Tables, written

NO_PROMOTION_KEY = 1
UNKNOWN_PAYMENT_KEY = 0


def dim_customer(stg: dict[str, DataFrame]) -> DataFrame:
    c = stg["stg_customers"].withColumn(
        "full_name", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")))
    return conform(dense_key(c, ["customer_id"], "customer_key"), STAR["dim_customer"])


def dim_category(stg: dict[str, DataFrame]) -> DataFrame:
    pairs = stg["stg_products"].select("category_name", "parent_category").distinct()
    return conform(dense_key(pairs, ["parent_category", "category_name"], "category_key"),
                   STAR["dim_category"])


def dim_product(stg: dict[str, DataFrame], categories: DataFrame) -> DataFrame:
    p = stg["stg_products"].join(categories, ["category_name", "parent_category"])
    p = p.withColumnRenamed("price", "unit_price").withColumnRenamed("cost", "unit_cost")
    return conform(dense_key(p, ["product_id"], "product_key"), STAR["dim_product"])


def dim_channel(stg: dict[str, DataFrame]) -> DataFrame:
    return conform(dense_key(stg["stg_sales_channels"], ["channel_id"], "channel_key"),
                   STAR["dim_channel"])


def dim_promotion(stg: dict[str, DataFrame]) -> DataFrame:
    """Key 1 is the reserved 'no promotion' member; promotions follow from 2."""
    promos = dense_key(stg["stg_promotions"], ["promotion_id"], "promotion_key",
                       start=NO_PROMOTION_KEY + 1)
    none = promos.sparkSession.range(1).select(
        F.lit(NO_PROMOTION_KEY).cast("long").alias("promotion_key"),
        F.lit(None).cast("long").alias("promotion_id"),
        F.lit("NONE").alias("promotion_code"),
        F.lit("No promotion applied").alias("description"),
        F.lit("none").alias("discount_type"),
        F.lit(0).cast("decimal(10,2)").alias("discount_value"))
    return conform(none.unionByName(promos.select(*STAR["dim_promotion"].names)),
                   STAR["dim_promotion"])


def dim_payment_method(stg: dict[str, DataFrame]) -> DataFrame:
    """Sorted distinct methods from 1, plus member 0 'UNKNOWN' for orders
    without a payment, so every fact key resolves."""
    methods = (stg["stg_payments"].select("payment_method")
               .where(F.col("payment_method").isNotNull()).distinct())
    keyed = dense_key(methods, ["payment_method"], "payment_method_key")
    unknown = keyed.sparkSession.range(1).select(
        F.lit(UNKNOWN_PAYMENT_KEY).cast("long").alias("payment_method_key"),
        F.lit("UNKNOWN").alias("payment_method"))
    return conform(unknown.unionByName(keyed), STAR["dim_payment_method"])


def dim_date(stg: dict[str, DataFrame]) -> DataFrame:
    """Calendar from the first to the last order or return day."""
    days = (stg["stg_orders"].select(F.to_date("order_date").alias("d"))
            .unionByName(stg["stg_returns"].select(F.to_date("return_date").alias("d"))))
    bounds = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    cal = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi")).alias("full_date"))  # one row per calendar day
    d = F.col("full_date")
    dow = F.weekday(d) + 1  # Monday = 1
    return conform(cal.select(
        date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"), (dow >= 6).alias("is_weekend"),
    ), STAR["dim_date"])


def one_payment_per_order(payments: DataFrame) -> DataFrame:
    """The lowest payment id's method per order (J3 de-duplication)."""
    return payments.groupBy("order_id").agg(
        F.min_by("payment_method", "payment_id").alias("payment_method"))


def paid_orders(stg: dict[str, DataFrame]) -> DataFrame:
    """What an order and its payment say of the order's lines."""
    orders = stg["stg_orders"].select(
        "order_id", "customer_id", "channel_id", "promotion_id",
        date_key(F.col("order_date")).alias("order_date_key"))
    return orders.join(one_payment_per_order(stg["stg_payments"]), "order_id", "left")


def order_lines(stg: dict[str, DataFrame], orders: DataFrame | None = None) -> DataFrame:
    """Order items with what their order and its payment say, or with
    ``orders`` made of that. All three tables meet on the order: over staging
    laid out by it, without a shuffle."""
    return stg["stg_order_items"].join(paid_orders(stg) if orders is None else orders, "order_id")


def keyed_orders(stg: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """Paid orders with the keys that all lines of an order share. An order is
    looked up once, not with each of its lines, and lines carry keys only."""
    methods = dims["dim_payment_method"].where(
        F.col("payment_method_key") != UNKNOWN_PAYMENT_KEY)
    promo_lookup = dims["dim_promotion"].where(F.col("promotion_id").isNotNull()) \
        .select("promotion_key", "promotion_id")
    orders = (paid_orders(stg)
              .join(dims["dim_customer"].select("customer_key", "customer_id"), "customer_id")
              .join(dims["dim_channel"].select("channel_key", "channel_id"), "channel_id"))
    # nullable keys (most orders have no promotion): NULLs spread, never match
    orders = left_lookup(orders, "payment_method", methods, "order_id", "payment_method_key")
    orders = left_lookup(orders, "promotion_id", promo_lookup, "order_id", "promotion_key")
    return orders.select("order_id", "order_date_key", "customer_key", "channel_key",
                         "promotion_key", "payment_method_key")


#: Bytes of input that a slice of the sales fact is built from: its shuffles take some ten times that.
SLICE_BYTES = 512 << 20


def fact_sales(stg: dict[str, DataFrame], dims: dict[str, DataFrame], input_bytes: int = 0) -> DataFrame:
    """One row per order item (B11). Inner joins drop items whose order,
    customer, product or channel is unknown; cancelled orders still count.

    A large fact is built in ``SLICE_BYTES`` slices of the input, by ranges of
    its lines' ids one after another, so that at any time the shuffles of one
    slice are on disk and not those of the whole fact."""
    orders = keyed_orders(stg, dims)
    slices = -(-input_bytes // SLICE_BYTES)
    if slices <= 1:
        return _numbered_sales([_sales(stg["stg_order_items"], orders, dims)])
    orders = written(orders, "keyed_orders")
    parts = []
    for lines, low, high in ranges(stg["stg_order_items"], "order_item_id", slices, "order_id"):
        near = orders.where(F.col("order_id").between(low, high))  # where ids go together, others are not shuffled
        parts.append(_sales(lines, near, dims))
    return _numbered_sales(parts)


def _sales(lines: DataFrame, orders: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact's rows of some lines, without what follows from their values."""
    fact = lines.join(orders, "order_id").join(
        dims["dim_product"].select("product_key", "product_id", "category_key"), "product_id")
    return fact.select(
        "order_id", "order_item_id", "order_date_key", "customer_key", "product_key",
        "category_key", "channel_key",
        F.coalesce(F.col("promotion_key"), F.lit(NO_PROMOTION_KEY)).alias("promotion_key"),
        F.coalesce(F.col("payment_method_key"), F.lit(UNKNOWN_PAYMENT_KEY))
        .alias("payment_method_key"),
        "quantity", "unit_price", "discount_amount",
        F.col("line_total").alias("net_revenue"),
    )


def _numbered_sales(parts: list[DataFrame]) -> DataFrame:
    fact = dense_key(parts[0], ["order_item_id"], "sales_key", 1, *parts[1:])  # what follows from a row's values is not shuffled
    return conform(fact.withColumn("gross_revenue", F.round(F.col("quantity") * F.col("unit_price"), 2)),
                   STAR["fact_sales"])


#: The written facts' partition column and the date key that it is the month of.
MONTHS = {"fact_sales": ("order_month", "order_date_key"), "fact_returns": ("return_month", "return_date_key")}

def fact_returns(stg: dict[str, DataFrame], sales: DataFrame) -> DataFrame:
    """Returns carrying the keys resolved for their sale (B12); returns
    without a sale are dropped."""
    keys = sales.select("order_item_id", "customer_key", "product_key", "channel_key")
    r = stg["stg_returns"].join(keys, "order_item_id").select(
        "return_id", "order_id", "order_item_id",
        date_key(F.col("return_date")).alias("return_date_key"),
        "customer_key", "product_key", "channel_key",
        F.col("quantity").alias("quantity_returned"), "refund_amount", "reason")
    return conform(dense_key(r, ["return_id"], "return_key"), STAR["fact_returns"])


def build_dimensions(stg: dict[str, DataFrame], store: LazyStore | None = None) -> dict[str, DataFrame]:
    """The dimensions; with a ``ParquetStore`` each table is written and read
    back before the next uses it."""
    store = store or LazyStore()
    dims = store.put_all({
        "dim_date": lambda: dim_date(stg),
        "dim_customer": lambda: dim_customer(stg),
        "dim_category": lambda: dim_category(stg),
        "dim_channel": lambda: dim_channel(stg),
        "dim_promotion": lambda: dim_promotion(stg),
        "dim_payment_method": lambda: dim_payment_method(stg),
    })
    dims["dim_product"] = store.put("dim_product", dim_product(stg, dims["dim_category"]))
    return {name: dims[name] for name in DIMENSIONS}


def dimensions_on_demand(stg: dict[str, DataFrame], store: LazyStore) -> Tables:
    """The dimensions, each kept in ``store`` when it is first asked for."""
    made = {"dim_date": dim_date, "dim_customer": dim_customer, "dim_category": dim_category, "dim_channel": dim_channel,
            "dim_promotion": dim_promotion, "dim_payment_method": dim_payment_method,
            "dim_product": lambda s: dim_product(s, dims["dim_category"])}
    dims = Tables({name: (lambda n=name: store.put(n, made[n](stg))) for name in DIMENSIONS})
    return dims


def facts_on_demand(stg: dict[str, DataFrame], store: LazyStore, dims: Tables, input_bytes: int = 0) -> Tables:
    """``dims`` and the facts, each kept in ``store`` when it is first asked for."""
    star = dims.over(
        fact_sales=lambda: store.put("fact_sales", fact_sales(stg, dims, input_bytes), MONTHS["fact_sales"], "order_item_id"),
        fact_returns=lambda: store.put("fact_returns", fact_returns(stg, star["fact_sales"]), MONTHS["fact_returns"],
                                       "return_id"))
    return star


def build_star(stg: dict[str, DataFrame], store: LazyStore | None = None,
               dims: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All star tables in dependency order, over ``dims`` if they are built."""
    store = store or LazyStore()
    dims = build_dimensions(stg, store) if dims is None else dims
    sales = store.put("fact_sales", fact_sales(stg, dims), MONTHS["fact_sales"], "order_item_id")
    returns = store.put("fact_returns", fact_returns(stg, sales), MONTHS["fact_returns"], "return_id")
    return {**dims, "fact_sales": sales, "fact_returns": returns}
