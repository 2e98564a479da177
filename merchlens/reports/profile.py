"""Base figures of the raw tables, without the sales mart's pairing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.catalog import RawTables
from merchlens.operators.checks import value_counts


def total_revenue(items: DataFrame) -> DataFrame:
    """Prices plus freight, as an amount and as text with thousands separators."""
    total = items.agg((F.sum("price") + F.sum("freight_value")).alias("total_revenue"))
    return total.withColumn("total_text", F.format_number("total_revenue", 2))


def avg_order_value_items(items: DataFrame) -> DataFrame:
    """Mean over orders of their summed prices; an order without prices counts as 0."""
    orders = (
        items.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.coalesce(F.sum("price"), F.lit(0)).alias("order_price"))
    )
    value = orders.agg(F.avg("order_price").alias("avg_order_value"))
    return value.withColumn("avg_text", F.format_number("avg_order_value", 2))


def entity_counts(raw: RawTables) -> DataFrame:
    """Distinct persons, sellers and products."""
    counted = (
        ("customers", raw.customers, "customer_unique_id"),
        ("sellers", raw.sellers, "seller_id"),
        ("products", raw.products, "product_id"),
    )
    rows = [
        frame.agg(F.count_distinct(key).alias("entities")).select(
            F.lit(name).alias("entity"),
            "entities",
            F.format_number("entities", 0).alias("entities_text"),
        )
        for name, frame, key in counted
    ]
    return reduce(DataFrame.unionByName, rows)


def top_categories_items(items: DataFrame, products: DataFrame, top: int = 15) -> DataFrame:
    """Categories with the highest summed prices; items without one are left out."""
    return (
        items.select("product_id", "price")
        .join(products.select("product_id", "product_category"), "product_id")
        .where(F.col("product_category").isNotNull())
        .groupBy("product_category")
        .agg(F.coalesce(F.sum("price"), F.lit(0)).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc("product_category"))
        .limit(top)
    )


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per rating, lowest rating first."""
    return value_counts(reviews, "star_rating").orderBy("star_rating")
