"""Promotion pricing of order lines (N21) and return pricing.

Re-expressed from the order generator's rules as Spark jobs over existing
orders: a percentage promotion discounts every line by ``round(gross*pct/100,
2)``; a fixed-amount promotion is a budget spent line by line in line order,
each line taking ``min(budget left, gross)``. After a line is capped the
budget is 0, so the budget left before a line is ``budget - sum(gross of the
earlier lines)`` floored at 0: a running sum, no sequential loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.functions.money import cents, from_cents, idiv
from shopstar.operators.lookup import left_lookup
from shopstar.operators.ordering import segmented_exclusive_sum


def price_order_lines(order_items: DataFrame, orders: DataFrame,
                      promotions: DataFrame) -> DataFrame:
    """Per line: gross, promotion discount and line total under the line's
    order promotion (no promotion: no discount)."""
    lines = (order_items.select("order_item_id", "order_id", "quantity", "unit_price")
             .join(orders.select("order_id", "promotion_id"), "order_id"))
    # most lines have no promotion: their NULL keys spread, never match
    lines = left_lookup(lines, "promotion_id", promotions, "order_item_id",
                        "promotion_code", "discount_type", "discount_value")
    gross_c = cents(F.col("quantity") * F.col("unit_price"))
    # totals of segments and sums inside them read the lines from the same shuffles
    lines = segmented_exclusive_sum(lines.withColumn("__gross_c", gross_c), ["order_id"], "order_item_id",
                                    "__gross_c", "__before_c")
    pct_c = cents(F.col("discount_value"))
    percent_c = idiv(F.col("__gross_c") * pct_c * 2 + 10_000, F.lit(20_000))
    budget_left = cents(F.col("discount_value")) - F.coalesce(F.col("__before_c"), F.lit(0))
    fixed_c = F.greatest(F.lit(0), F.least(F.col("__gross_c"), budget_left))
    discount_c = (F.when(F.col("discount_type") == "percentage", percent_c)
                  .when(F.col("discount_type") == "fixed_amount", fixed_c)
                  .otherwise(F.lit(0)))
    return lines.select(
        "order_item_id", "order_id",
        F.coalesce(F.col("promotion_code"), F.lit("NONE")).alias("promotion_code"),
        from_cents(F.col("__gross_c")).alias("gross_amount"),
        from_cents(discount_c).alias("promo_discount"),
        from_cents(F.col("__gross_c") - discount_c).alias("line_total"),
    )


def price_returns(returned: DataFrame, window_end_col: str) -> DataFrame:
    """Refund the net share of the returned units, ``round(line_total *
    returned / quantity, 2)`` half-up, and date the return ``days_after`` the
    order, but no later than the window end.

    Expects columns order_date, quantity, line_total, quantity_returned,
    days_after and ``window_end_col``."""
    refund_c = idiv(cents(F.col("line_total")) * F.col("quantity_returned") * 2
                    + F.col("quantity"), F.col("quantity") * 2)
    day = F.least(F.date_add(F.to_date("order_date"), F.col("days_after").cast("int")),
                  F.col(window_end_col))
    return returned.withColumn("refund_amount", from_cents(refund_c)) \
        .withColumn("return_date", day.cast("timestamp_ntz"))
