"""Delivery reports. Each takes the raw tables, a stored delivery mart, or its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.fixed_values import (
    DELIVERY_BUCKET_BEYOND,
    DELIVERY_BUCKETS,
    LATE_DAYS,
    PROBLEM_ROUTE_DAYS,
)
from merchlens.functions import month_start
from merchlens.marts.builders import delivered_orders, transit_days
from merchlens.marts.delivery_rows import as_delivery


def average_days() -> Column:
    """Mean days in transit over items: an exact integer sum over a count."""
    return F.sum(F.col("delivery_days") * F.col("items")) / F.sum("items")


def late_share(delivery, days: int = LATE_DAYS) -> DataFrame:
    """Share of orders in transit for more than `days`, cut to a whole percent.

    Fails on a mart without orders, as any division by their count does.
    """
    orders = as_delivery(delivery).rows().groupBy("order_id").agg(F.max("delivery_days").alias("d"))
    counts = orders.agg(F.count_if(F.col("d") > days).alias("late"), F.count("d").alias("orders"))
    share = F.expr("(100 * late) div orders").cast("decimal(10,2)") / 100
    return counts.select(share.cast("decimal(10,2)").alias("late_share"))


def delivery_trend(orders: DataFrame) -> DataFrame:
    """Mean days in transit by month of delivery, each order counted once."""
    month = month_start(F.col("order_delivered_customer_date")).alias("month")
    return (
        delivered_orders(orders)
        .select(month, transit_days().alias("delivery_days"))
        .groupBy("month")
        .agg((F.sum("delivery_days") / F.count("delivery_days")).alias("avg_delivery_days"))
    )


def delivery_median(orders: DataFrame) -> DataFrame:
    """Median of days in transit over delivered orders.

    Orders collapse to one row per number of days, so what is ordered and summed
    is a list of possible durations and not the orders themselves.
    """
    per_day = (
        delivered_orders(orders)
        .select(transit_days().alias("delivery_days"))
        .groupBy("delivery_days")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return per_day.agg(
        F.percentile("delivery_days", F.lit(0.5), F.col("orders")).alias("median_delivery_days")
    )


def delivery_by_state(delivery) -> DataFrame:
    """Mean days in transit by state of the customer, slowest first."""
    return (
        as_delivery(delivery)
        .rows("customer_state")
        .groupBy("customer_state")
        .agg(average_days().alias("avg_delivery_days"))
        .orderBy(F.desc_nulls_first("avg_delivery_days"))
    )


def delivery_bucket(days: Column) -> Column:
    """Label of the first bucket whose upper bound exceeds the days."""
    label = F
    for bound, name in DELIVERY_BUCKETS:
        label = label.when(days < bound, name)
    return label.otherwise(DELIVERY_BUCKET_BEYOND)


def delivery_histogram(delivery) -> DataFrame:
    """Orders per bucket of days in transit, shortest bucket first."""
    source = as_delivery(delivery)
    return (
        source.rows()
        .groupBy(delivery_bucket(F.col("delivery_days")).alias("delivery_bucket"))
        .agg(source.order_count().alias("deliveries"), F.min("delivery_days").alias("shortest"))
        .orderBy("shortest")
        .drop("shortest")
    )


def problem_routes(delivery, days: int = PROBLEM_ROUTE_DAYS) -> DataFrame:
    """Routes between cities whose mean time in transit exceeds `days`.

    City pairs that read the same share one route, which is why orders are
    counted distinct.
    """
    route = F.concat("seller_city", F.lit(" -> "), "customer_city").alias("route")
    return (
        as_delivery(delivery)
        .rows("seller_city", "seller_state", "customer_city", "customer_state")
        .groupBy(route, "seller_state", "customer_state")
        .agg(
            average_days().alias("avg_delivery_days"),
            F.count_distinct("order_id").alias("orders"),
        )
        .where(F.col("avg_delivery_days") > days)
        .orderBy(F.desc_nulls_first("avg_delivery_days"))
    )


def fastest_cities(delivery, top: int = 10) -> DataFrame:
    """Seller cities with the shortest mean time in transit."""
    source = as_delivery(delivery)
    return (
        source.rows("seller_city")
        .groupBy("seller_city")
        .agg(
            average_days().alias("avg_delivery_days"),
            source.order_count().alias("deliveries"),
        )
        .orderBy(F.asc_nulls_last("avg_delivery_days"), F.asc_nulls_last("seller_city"))
        .limit(top)
    )
