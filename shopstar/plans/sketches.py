"""Mergeable distinct counts (A2): HyperLogLog sketches by day and key.

Distinct orders and customers do not add up over days, so an exact count reads
the fact again for each slice. A sketch does: one row per day, category and
channel holds the sketches of its orders and customers beside its sums, and any
slice's counts are the union of its rows' sketches. The stored table has as many
rows as those keys have combinations, whatever the fact's size; a sketch takes
some kilobytes at most. The estimate's standard error is 1.04 / sqrt(2^LOG_K),
0.8 %, and small counts are nearly exact. Opt-in: the exact questions stay as
they are.
"""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.functions.filters import EVERYTHING, QueryFilters
from shopstar.session import setting
from shopstar.sources.store import written

LOG_K = 14
KEYS = ("order_date_key", "category_key", "channel_key")
SUMS = {"gross_revenue": "gross_revenue", "total_discounts": "discount_amount", "net_revenue": "net_revenue",
        "units_sold": "quantity"}


def daily_sketches(star: dict[str, DataFrame], log_k: int = LOG_K) -> DataFrame:
    """A row per day, category and channel: sums, and sketches of orders and
    customers. The fact's few columns are range-partitioned and sorted by those
    keys, so a group's lines come one after another and fill one sketch:
    merging sketches of a few lines each copies a growing one per merge. Keep it
    by :func:`stored_sketches`."""
    lines = star["fact_sales"].select(*KEYS, "order_id", "customer_key", *SUMS.values())
    return lines.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS).groupBy(*KEYS).agg(
        F.hll_sketch_agg("order_id", log_k).alias("orders"), F.hll_sketch_agg("customer_key", log_k).alias("customers"),
        *[F.sum(c).alias(n) for n, c in SUMS.items()])


def stored_sketches(star: dict[str, DataFrame], log_k: int = LOG_K) -> DataFrame:
    """:func:`daily_sketches` as a written table, its files clustered by day: a
    task that reads some holds few months. Sorted groups are aggregated in one
    step, in their order."""
    with setting(star["fact_sales"].sparkSession, "spark.sql.execution.replaceHashWithSortAgg", "true"):
        return written(daily_sketches(star, log_k), "sales_sketches")


def sketched_kpis(star: dict[str, DataFrame], sketches: DataFrame, filters: QueryFilters = EVERYTHING,
                  *by: str) -> DataFrame:
    """Sums and estimated distinct orders and customers of a slice, in all or
    per ``by`` columns (of the sketches or of ``dim_date``), from the stored
    sketches: the fact is not read."""
    rows = filters.sales(ChainMap({"fact_sales": sketches}, star))
    days = F.broadcast(star["dim_date"].withColumnRenamed("date_key", "order_date_key"))
    rows = rows.join(days, "order_date_key") if set(by) - set(rows.columns) else rows
    return rows.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("orders"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"),
        *[F.sum(n).alias(n) for n in SUMS])


def sketch_errors(star: dict[str, DataFrame], sketches: DataFrame, bound: float = 0.05) -> DataFrame:
    """Per month and channel the exact distinct orders and customers, the net
    revenue, and whether the sketches' estimates are within ``bound`` of them."""
    by = ("year", "month", "channel_key")
    days = F.broadcast(star["dim_date"].select(F.col("date_key").alias("order_date_key"), "year", "month"))
    exact = star["fact_sales"].join(days, "order_date_key").groupBy(*by).agg(
        F.count_distinct("order_id").alias("exact_orders"), F.count_distinct("customer_key").alias("exact_customers"))
    both = sketched_kpis(star, sketches, EVERYTHING, *by).join(exact, [*by])

    def close(name: str):
        return F.abs(F.col(name) - F.col(f"exact_{name}")) <= bound * F.col(f"exact_{name}")

    return both.join(star["dim_channel"].select("channel_key", "channel_name"), "channel_key").select(
        "year", "month", "channel_name", F.col("exact_orders").alias("orders"),
        F.col("exact_customers").alias("customers"), F.col("net_revenue").cast("double").alias("net_revenue"),
        close("orders").alias("orders_close"), close("customers").alias("customers_close"))
