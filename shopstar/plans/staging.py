"""Staging: cleaned, de-duplicated twins of the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.functions.cleaning import dedupe_first, dedupe_rare, strip, trim_strings, utc_naive
from shopstar.sources.schemas import STAGING_COLUMNS, STG_CUSTOMERS, STG_PRODUCTS, conform
from shopstar.sources.store import LazyStore, Tables

PLAIN_TABLES = tuple(STAGING_COLUMNS)


def stage_table(src: dict[str, DataFrame], name: str, store: LazyStore | None = None) -> DataFrame:
    """Project the staged columns, strip strings, one row per first column
    (B1). Without repeats the table is its source row by row: a view."""
    store = store or LazyStore()
    rows = trim_strings(src[name].select(*STAGING_COLUMNS[name]))
    out = dedupe_rare(rows, STAGING_COLUMNS[name][0])
    keep = store.view if out is rows else store.put
    return keep(f"stg_{name}", out.select(*STAGING_COLUMNS[name]))


def stage_customers(src: dict[str, DataFrame]) -> DataFrame:
    """Customers with their billing geography (B2): left join, since a
    customer may have no billing address."""
    billing = (src["customer_addresses"]
               .where(F.col("address_type") == F.lit("billing"))
               .groupBy("customer_id")
               .agg(F.min_by(F.struct("city", "state", "country"), F.col("address_id"))
                    .alias("g"))
               .select("customer_id", "g.city", "g.state", "g.country"))
    people = src["customers"].select("customer_id", "first_name", "last_name", "email",
                                     "phone", "signup_date")
    frame = trim_strings(people.join(billing, "customer_id", "left"))
    frame = frame.withColumn("email", F.lower("email"))
    return conform(dedupe_first(frame, "customer_id"), STG_CUSTOMERS)


def stage_products(src: dict[str, DataFrame]) -> DataFrame:
    """Flatten catalog documents into one relational row each."""
    d = src["products"]

    def named(c):
        return strip(F.coalesce(F.nullif(c, F.lit("")), F.lit("Unknown")))

    flat = d.select(
        F.col("product_id"),
        strip(F.coalesce(F.col("name"), F.lit(""))).alias("product_name"),
        F.col("brand.name").alias("brand"),
        named(F.col("category.name")).alias("category_name"),
        named(F.col("category.parent")).alias("parent_category"),
        F.coalesce(F.col("pricing.price"), F.lit(0)).cast("decimal(10,2)").alias("price"),
        F.coalesce(F.col("pricing.cost"), F.lit(0)).cast("decimal(10,2)").alias("cost"),
        F.concat_ws(",", F.col("tags")).alias("tags"),
        F.coalesce(F.col("attributes"), F.lit("{}")).alias("attributes"),
        F.when(F.col("variants").isNull(), F.lit(0)).otherwise(F.size("variants"))
        .cast("int").alias("variant_count"),
        utc_naive(F.col("metadata.created_at")).alias("created_at"),
    )
    return conform(dedupe_first(flat, "product_id"), STG_PRODUCTS)


def stage_on_demand(src: Tables, store: LazyStore) -> Tables:
    """Every staged table, each kept in ``store`` when it is first asked for."""
    return Tables({
        **{f"stg_{name}": (lambda n=name: stage_table(src, n, store)) for name in PLAIN_TABLES},
        "stg_customers": lambda: store.put("stg_customers", stage_customers(src)),
        "stg_products": lambda: store.put("stg_products", stage_products(src))})


def stage_all(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every staged table, keyed ``stg_<name>``."""
    out = {f"stg_{name}": stage_table(src, name) for name in PLAIN_TABLES}
    out["stg_customers"] = stage_customers(src)
    out["stg_products"] = stage_products(src)
    return out
