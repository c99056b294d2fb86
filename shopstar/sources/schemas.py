"""Explicit schemas for every table: source (OLTP + catalog documents),
staging and star. Nothing is inferred; writes select by these names and
cast to these types (positional loads in the star depend on column order)."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, I, D, TS, B = (T.LongType(), T.StringType(), T.IntegerType(), T.DateType(),
                     T.TimestampNTZType(), T.BooleanType())
MONEY = T.DecimalType(10, 2)   # unit amounts
AMOUNT = T.DecimalType(12, 2)  # line and order amounts


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ----------------------------------------------------------------- sources
SOURCE = {
    "sales_channels": _struct(("channel_id", L), ("channel_name", S), ("channel_type", S)),
    "promotions": _struct(("promotion_id", L), ("promotion_code", S), ("description", S),
                          ("discount_type", S), ("discount_value", MONEY),
                          ("start_date", D), ("end_date", D)),
    "customers": _struct(("customer_id", L), ("first_name", S), ("last_name", S),
                         ("email", S), ("phone", S), ("signup_date", D)),
    "customer_addresses": _struct(("address_id", L), ("customer_id", L), ("address_type", S),
                                  ("street", S), ("city", S), ("state", S), ("country", S),
                                  ("postal_code", S)),
    "orders": _struct(("order_id", L), ("customer_id", L), ("channel_id", L),
                      ("promotion_id", L), ("order_date", TS), ("status", S),
                      ("total_amount", AMOUNT)),
    "order_items": _struct(("order_item_id", L), ("order_id", L), ("product_id", S),
                           ("quantity", I), ("unit_price", MONEY),
                           ("discount_amount", MONEY), ("line_total", AMOUNT)),
    "payments": _struct(("payment_id", L), ("order_id", L), ("payment_method", S),
                        ("amount", AMOUNT), ("payment_date", TS), ("status", S)),
    "returns": _struct(("return_id", L), ("order_id", L), ("order_item_id", L),
                       ("return_date", TS), ("quantity", I), ("refund_amount", AMOUNT),
                       ("reason", S)),
}

# Product catalog document: nested structs, array of struct, array of string.
# ``attributes`` has keys that vary by category, so it is kept as JSON text.
PRODUCT_DOCUMENT = _struct(
    ("product_id", S), ("name", S), ("description", S),
    ("brand", _struct(("name", S))),
    ("category", _struct(("name", S), ("parent", S), ("path", S))),
    ("pricing", _struct(("price", MONEY), ("cost", MONEY), ("currency", S))),
    ("attributes", S),
    ("variants", T.ArrayType(_struct(("sku", S), ("color", S), ("size", S), ("stock", I)))),
    ("tags", T.ArrayType(S)),
    ("metadata", _struct(("created_at", S), ("source", S))),
)

# ----------------------------------------------------------------- staging
# Columns kept per staged table; the first one is the dedupe key.
STAGING_COLUMNS: dict[str, list[str]] = {
    name: SOURCE[name].names
    for name in ("sales_channels", "promotions", "customer_addresses", "orders",
                 "order_items", "payments", "returns")
}

STG_CUSTOMERS = _struct(("customer_id", L), ("first_name", S), ("last_name", S), ("email", S),
                        ("phone", S), ("signup_date", D), ("city", S), ("state", S),
                        ("country", S))
STG_PRODUCTS = _struct(("product_id", S), ("product_name", S), ("brand", S),
                       ("category_name", S), ("parent_category", S), ("price", MONEY),
                       ("cost", MONEY), ("tags", S), ("attributes", S), ("variant_count", I),
                       ("created_at", TS))

# -------------------------------------------------------------------- star
STAR = {
    "dim_date": _struct(("date_key", I), ("full_date", D), ("year", I), ("quarter", I),
                        ("month", I), ("month_name", S), ("day", I), ("day_of_week", I),
                        ("day_name", S), ("week_of_year", I), ("is_weekend", B)),
    "dim_customer": _struct(("customer_key", L), ("customer_id", L), ("full_name", S),
                            ("email", S), ("city", S), ("state", S), ("country", S),
                            ("signup_date", D)),
    "dim_category": _struct(("category_key", L), ("category_name", S), ("parent_category", S)),
    "dim_product": _struct(("product_key", L), ("product_id", S), ("product_name", S),
                           ("brand", S), ("category_key", L), ("category_name", S),
                           ("unit_price", MONEY), ("unit_cost", MONEY)),
    "dim_channel": _struct(("channel_key", L), ("channel_id", L), ("channel_name", S),
                           ("channel_type", S)),
    "dim_promotion": _struct(("promotion_key", L), ("promotion_id", L), ("promotion_code", S),
                             ("description", S), ("discount_type", S),
                             ("discount_value", MONEY)),
    "dim_payment_method": _struct(("payment_method_key", L), ("payment_method", S)),
    "fact_sales": _struct(("sales_key", L), ("order_id", L), ("order_item_id", L),
                          ("order_date_key", I), ("customer_key", L), ("product_key", L),
                          ("category_key", L), ("channel_key", L), ("promotion_key", L),
                          ("payment_method_key", L), ("quantity", I), ("unit_price", MONEY),
                          ("gross_revenue", AMOUNT), ("discount_amount", AMOUNT),
                          ("net_revenue", AMOUNT)),
    "fact_returns": _struct(("return_key", L), ("return_id", L), ("order_id", L),
                            ("order_item_id", L), ("return_date_key", I), ("customer_key", L),
                            ("product_key", L), ("channel_key", L), ("quantity_returned", I),
                            ("refund_amount", AMOUNT), ("reason", S)),
    "pipeline_runs": _struct(("run_id", L), ("step_name", S), ("row_counts", S),
                             ("completed_at", TS)),
}

DIMENSIONS = ("dim_date", "dim_customer", "dim_category", "dim_product", "dim_channel",
              "dim_promotion", "dim_payment_method")
FACTS = ("fact_sales", "fact_returns")


def conform(df, schema: T.StructType):
    """Select ``schema``'s columns by name, in order, cast to its types."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
