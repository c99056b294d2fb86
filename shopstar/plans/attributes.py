"""Open product attributes (P6, P8) as values, not text.

A catalog document's attributes have keys that vary by category. Staging keeps
them as JSON text; here they are parsed once into Spark's VARIANT, whose fields
are read by path or exploded into rows without a schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What ``schema_of_variant`` calls a value's type, and what it is called here.
KINDS = {"number": "BIGINT|DECIMAL.*|DOUBLE|FLOAT", "text": "STRING", "boolean": "BOOLEAN"}


def with_attributes(products: DataFrame) -> DataFrame:
    """Staged products with ``attributes`` as VARIANT; malformed text is an error."""
    return products.withColumn("attributes", F.parse_json("attributes"))


def attribute(name: str, kind: str) -> Column:
    """One attribute as ``kind``; NULL where it is missing or of another type."""
    return F.try_variant_get("attributes", "$[" + repr(name) + "]", kind)


def attribute_rows(products: DataFrame) -> DataFrame:
    """(product_id, parent_category, attribute, kind, value): a row per
    attribute of a product, the value as JSON text, keys as they come."""
    kind = F.lit("other")
    for name, pattern in KINDS.items():
        kind = F.when(F.schema_of_variant("value").rlike(f"^({pattern})$"), name).otherwise(kind)
    spark = products.sparkSession
    rows = with_attributes(products).lateralJoin(
        spark.tvf.variant_explode(F.col("attributes").outer()))
    return rows.select("product_id", "parent_category", F.col("key").alias("attribute"), kind.alias("kind"),
                       F.to_json(F.col("value")).alias("value"), F.try_variant_get("value", "$", "double").alias("number"))


def attribute_counts(products: DataFrame) -> DataFrame:
    """Which attributes the products of a category have: how many products, how
    many different values, and the range of the numbers."""
    return attribute_rows(products).groupBy("parent_category", "attribute", "kind").agg(
        F.count("*").alias("products"), F.count_distinct("value").alias("distinct_values"),
        F.min(F.when(F.col("kind") == "number", F.col("number"))).alias("least"),
        F.max(F.when(F.col("kind") == "number", F.col("number"))).alias("most"))
