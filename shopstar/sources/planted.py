"""Tables with planted errors, so that checks, de-duplication and dropping
joins have something to find.

Each entry changes columns of a clean table and adds copies of some of its
rows. The expressions are plain SQL that Spark and the DuckDB oracle both
read, so both sides plant the same errors.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.sources.store import Tables


@dataclass(frozen=True)
class Plant:
    """``changes``: column -> (condition, value where it holds), all from the
    clean row. ``copies``: conditions whose rows come once more, unchanged."""
    changes: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    copies: tuple[str, ...] = ()

    def expression(self, column: str) -> str:
        cases = self.changes.get(column)
        return column if not cases else "CASE " + " ".join(
            f"WHEN {c} THEN {v}" for c, v in cases) + f" ELSE {column} END"


_PRODUCT = "CAST(substr(product_id, 2) AS INTEGER)"

STAGING = {
    "stg_sales_channels": Plant(copies=("channel_id = 2",)),
    "stg_promotions": Plant(
        {"discount_type": [("promotion_id % 5 = 0", "'gift'")], "discount_value": [("promotion_id % 6 = 0", "0")],
         "end_date": [("promotion_id % 7 = 0", "DATE '1990-01-01'")],
         "promotion_code": [("promotion_id % 8 = 0", "'PROMO001'")]}, ("promotion_id % 9 = 0",)),
    "stg_customer_addresses": Plant(
        {"address_type": [("address_id % 10 = 0", "'office'")], "customer_id": [("address_id % 11 = 0", "-1")]},
        ("address_id % 12 = 0",)),
    "stg_customers": Plant(
        {"email": [("customer_id % 10 = 1", "NULL"), ("customer_id % 10 = 2", "''"),
                   ("customer_id % 10 = 3", "'no at sign'")]}, ("customer_id % 10 = 4",)),
    "stg_products": Plant(
        {"category_name": [(f"{_PRODUCT} % 10 = 1", "''")], "parent_category": [(f"{_PRODUCT} % 10 = 2", "NULL")]},
        (f"{_PRODUCT} % 10 = 3",)),
    "stg_orders": Plant(
        {"order_date": [("order_id % 12 = 1", "NULL")], "status": [("order_id % 9 = 0", "'lost'")],
         "total_amount": [("order_id % 11 = 2", "-5.00"), ("order_id % 11 = 3", "total_amount + 1")],
         "customer_id": [("order_id % 13 = 3", "-1")], "channel_id": [("order_id % 14 = 0", "99"),
                                                                      ("order_id % 14 = 1", "NULL")],
         "promotion_id": [("order_id % 15 = 0", "999")]}, ("order_id % 16 = 5",)),
    "stg_order_items": Plant(
        {"quantity": [("order_item_id % 17 = 0", "0")], "unit_price": [("order_item_id % 18 = 0", "-1.00")],
         "product_id": [("order_item_id % 19 = 0", "'PX'")], "order_id": [("order_item_id % 23 = 0", "-5")]},
        ("order_item_id % 31 = 0",)),
    "stg_payments": Plant(
        {"payment_method": [("payment_id % 7 = 0", "'cash'")], "status": [("payment_id % 8 = 0", "'odd'")],
         "amount": [("payment_id % 9 = 0", "-1.00")], "order_id": [("payment_id % 11 = 0", "-1")]},
        ("payment_id % 13 = 0",)),
    "stg_returns": Plant(
        {"quantity": [("return_id % 5 = 0", "0")], "order_id": [("return_id % 6 = 0", "-1")],
         "order_item_id": [("return_id % 7 = 0", "-1")]}, ("return_id % 8 = 0",)),
}

STAR = {
    "dim_date": Plant(copies=("day = 1",)),
    "dim_customer": Plant({"email": [("customer_key % 10 = 0", "'shared@x.com'")]}, ("customer_key % 11 = 0",)),
    "dim_category": Plant({"category_name": [("category_key % 4 = 0", "' ' || category_name"),
                                             ("category_key % 4 = 1", "'Twin'"), ("category_key % 4 = 2", "'TWIN'")]},
                          ("category_key % 5 = 0",)),
    "dim_product": Plant({"category_key": [("product_key % 10 = 0", "-1")]}, ("product_key % 11 = 0",)),
    "dim_channel": Plant(copies=("channel_key = 1",)),
    "dim_promotion": Plant(copies=("promotion_key = 2",)),
    "dim_payment_method": Plant(copies=("payment_method_key = 1",)),
    "fact_sales": Plant(
        {k: [(f"order_item_id % {n} = 0", "-1"), (f"order_item_id % {n} = 1", "NULL")] for k, n in (
            ("order_date_key", 40), ("customer_key", 41), ("product_key", 42), ("category_key", 43),
            ("channel_key", 44), ("promotion_key", 45), ("payment_method_key", 46))}
        | {"quantity": [("order_item_id % 47 = 0", "0")], "net_revenue": [("order_item_id % 48 = 0", "net_revenue + 1")]},
        ("order_item_id % 49 = 0",)),
    "fact_returns": Plant(
        {k: [(f"return_id % {n} = 0", "-1"), (f"return_id % {n} = 1", "NULL")] for k, n in (
            ("return_date_key", 10), ("customer_key", 11), ("product_key", 12), ("channel_key", 13))}
        | {"quantity_returned": [("return_id % 14 = 0", "0")], "refund_amount": [("return_id % 15 = 0", "9999999.00")]},
        ("return_id % 16 = 0",)),
}

#: Keys without a match, no copies: the inner joins of the fact must drop these lines.
DANGLING = {
    "stg_orders": Plant({"customer_id": [("order_id % 10 = 1", "-1")], "channel_id": [("order_id % 10 = 2", "99")],
                         "promotion_id": [("order_id % 10 = 3", "999")]}),
    "stg_order_items": Plant({"product_id": [("order_item_id % 10 = 4", "'PX'")],
                              "order_id": [("order_item_id % 10 = 5", "-5")]}),
    "stg_payments": Plant({"payment_method": [("payment_id % 10 = 6", "NULL")]}),
}

#: Repeated keys in the source: staging must keep one row of each.
REPEATED = {
    "orders": Plant({"customer_id": [("order_id % 4 = 0", "NULL")]}, ("order_id % 4 = 0", "order_id % 3 = 0")),
    "payments": Plant({"payment_method": [("payment_id % 4 = 0", "'  zz '")]}, ("payment_id % 4 = 0",)),
    "customer_addresses": Plant({"city": [("address_id % 3 = 0", "'AAA'")]}, ("address_id % 3 = 0",)),
}


def planted(tables: Mapping[str, DataFrame], plants: dict[str, Plant]) -> Tables:
    """``tables`` with ``plants`` applied, types unchanged; a table is planted,
    and built, when it is asked for."""
    def change(name: str) -> DataFrame:
        clean, plant = tables[name], plants[name]
        changed = clean.select(*[F.expr(plant.expression(f.name)).cast(f.dataType).alias(f.name)
                                 for f in clean.schema.fields])
        for condition in plant.copies:
            changed = changed.unionByName(clean.where(condition))
        return changed

    return Tables({name: (lambda n=name: change(n) if n in plants else tables[n]) for name in tables})
