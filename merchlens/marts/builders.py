"""Sales, delivery and purchasing-power marts from the raw tables.

No join carries a broadcast hint: Spark broadcasts a side when its known or
measured size is below spark.sql.autoBroadcastJoinThreshold and shuffles it
otherwise, so small sellers and products stay cheap and grown ones stay safe.
Items and payments alone are merged, as their pairs, the widest rows of all, then come
by order, and take a third less room where they are shuffled or stored next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.catalog import RawTables
from merchlens.fixed_values import DELIVERED_STATUS
from merchlens.functions import day_part, hour_part


def sales_mart(raw: RawTables, by_order: bool = False) -> DataFrame:
    """One row for every pair of item and payment of the same order.

    Customers are joined between payments and items: each join then follows a
    shuffle of both of its sides, which is what lets Spark split a partition made
    heavy by one order's payments, one customer's orders, or one order's items.

    Tables that are stored `by_order` are paired first, where they lie, and customers,
    products and sellers joined to the pairs: nothing is then shuffled by order. Choose it
    for such tables only, as no partition of theirs can be split.
    """
    orders = raw.orders.select(
        "order_id", "customer_id", "order_purchase_timestamp", "order_status"
    )
    customers = raw.customers.select("customer_id", "customer_city", "customer_state")
    payments = raw.payments.select("order_id", "payment_type", "payment_value")
    items = raw.order_items.select("order_id", "product_id", "seller_id", "price", "freight_value")
    products = raw.products.select("product_id", "product_category")
    sellers = raw.sellers.select("seller_id", "seller_city", "seller_state")
    if by_order:
        paired = payments.join(orders, "order_id").join(items, "order_id")
        sold = paired.join(products, "product_id").join(sellers, "seller_id")
        joined = sold.join(customers, "customer_id")
    else:
        sold = items.join(products, "product_id").join(sellers, "seller_id")
        paid = payments.join(orders, "order_id").join(customers, "customer_id")
        joined = paid.join(sold.hint("merge"), "order_id")
    return (
        joined.select(
            "order_id",
            "order_purchase_timestamp",
            "order_status",
            "product_category",
            "customer_id",
            "customer_city",
            "customer_state",
            "seller_city",
            "seller_state",
            "price",
            "freight_value",
            "payment_type",
            "payment_value",
        )
    )


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Orders handed to the carrier and to the customer, whatever their status."""
    return orders.where(
        F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_delivered_carrier_date").isNotNull()
    )


def transit_days():
    return day_part(F.col("order_delivered_customer_date"), F.col("order_delivered_carrier_date"))


def delivery_mart(raw: RawTables) -> DataFrame:
    """One row per item of a delivered order, with its time in transit."""
    orders = delivered_orders(raw.orders).select(
        "order_id",
        "customer_id",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    )
    customers = raw.customers.select("customer_id", "customer_state", "customer_city")
    items = raw.order_items.select("order_id", "seller_id")
    sellers = raw.sellers.select("seller_id", "seller_state", "seller_city")
    hours = hour_part(
        F.col("order_delivered_customer_date"), F.col("order_delivered_carrier_date")
    )
    return (
        orders.join(customers, "customer_id")
        .join(items.join(sellers, "seller_id"), "order_id")
        .withColumn("delivery_days", transit_days())
        .withColumn("delivery_hours", hours)
        .select(
            "order_id",
            "seller_id",
            "seller_state",
            "seller_city",
            "order_delivered_carrier_date",
            "customer_id",
            "customer_state",
            "customer_city",
            "order_delivered_customer_date",
            "delivery_days",
            "delivery_hours",
            F.concat(
                F.col("delivery_days").cast("string"),
                F.lit(" days "),
                F.col("delivery_hours").cast("string"),
                F.lit(" hours"),
            ).alias("delivery_time"),
        )
    )


def purchasing_power_mart(raw: RawTables) -> DataFrame:
    """One row per payment of a delivered order, with its customer."""
    orders = raw.orders.where(F.col("order_status") == DELIVERED_STATUS).select(
        "order_id", "customer_id", "order_purchase_timestamp"
    )
    customers = raw.customers.select(
        "customer_id", "customer_unique_id", "customer_state", "customer_city"
    )
    payments = raw.payments.select(
        "order_id", "payment_type", "payment_installments", "payment_value"
    )
    return (
        orders.join(customers, "customer_id")
        .join(payments, "order_id")
        .select(
            "customer_id",
            "customer_unique_id",
            "customer_state",
            "customer_city",
            "payment_type",
            "payment_installments",
            "payment_value",
            "order_id",
            "order_purchase_timestamp",
        )
    )
