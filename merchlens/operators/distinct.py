"""Distinct orders and customers of the same rows, counted without expanding them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def per_customer(rows: DataFrame, *keys: str, unique_orders: bool) -> DataFrame:
    """Sales rows collapsed to one for each customer and combination of keys.

    Returns the keys, customer_id, price, payment_value and `orders`. Over the customers of
    a combination of keys, `orders` adds up to its distinct orders and the rows that have
    a customer are its distinct customers, so both counts are plain ones.

    Rows are collapsed by order and customer first, which Spark combines before it shuffles
    them. With `unique_orders` an order has one row per combination of keys. Else an order
    that comes with several customers, as it does where its id is repeated, counts for the
    first of them by id.
    """
    price, paid = F.sum("price").alias("price"), F.sum("payment_value").alias("payment_value")
    if unique_orders:
        orders = F.count("order_id")
    else:
        rows = rows.groupBy(*keys, "order_id", "customer_id").agg(price, paid)
        first = Window.partitionBy(*keys, "order_id").orderBy("customer_id")
        counts = (F.row_number().over(first) == 1) & F.col("order_id").isNotNull()
        rows = rows.withColumn("counts", counts)
        orders = F.count_if("counts")
    return rows.groupBy(*keys, "customer_id").agg(price, paid, orders.alias("orders"))
