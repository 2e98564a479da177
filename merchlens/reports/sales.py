"""Sales reports. Each takes the raw tables, a stored sales mart, or sales rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions import month_start, ratio
from merchlens.marts.sales_rows import as_sales
from merchlens.operators.distinct import per_customer
from merchlens.operators.metrics import metric_value
from merchlens.operators.periods import active, period_bucket, sold_in


def sales_monthly(sales) -> DataFrame:
    """Revenue, turnover and orders by month of purchase, over all statuses."""
    source = as_sales(sales)
    month = month_start(F.col("order_purchase_timestamp")).alias("month")
    return (
        source.rows()
        .groupBy(month)
        .agg(
            F.sum("price").alias("net_revenue"),
            F.sum("payment_value").alias("turnover"),
            source.order_count().alias("orders"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def kpi(sales, metric: str, period: str) -> DataFrame:
    """One metric over one trailing period, in one row."""
    source = as_sales(sales)
    rows = sold_in(source, period)
    return rows.agg(metric_value(metric, source).alias("value"))


def kpi_trend(sales, metric: str, period: str) -> DataFrame:
    """One metric over one trailing period, by month for the year, else by week."""
    source = as_sales(sales)
    return (
        sold_in(source, period)
        .groupBy(period_bucket(period).alias("period_date"))
        .agg(metric_value(metric, source).alias("value"))
        .orderBy(F.asc_nulls_last("period_date"))
    )


def kpi_by_state(sales, metric: str, period: str) -> DataFrame:
    """One metric over one trailing period, by state of the customer."""
    source = as_sales(sales)
    return (
        sold_in(source, period, "customer_state")
        .groupBy("customer_state")
        .agg(metric_value(metric, source).alias("value"))
        .orderBy(F.asc_nulls_last("customer_state"))
    )


def top_categories(sales, metric: str, period: str, top: int = 10) -> DataFrame:
    """Product categories with the highest metric; NULL metrics come first."""
    source = as_sales(sales)
    return (
        sold_in(source, period, "product_category")
        .groupBy("product_category")
        .agg(metric_value(metric, source).alias("value"))
        .orderBy(F.desc_nulls_first("value"), F.asc_nulls_last("product_category"))
        .limit(top)
    )


def payment_methods(sales) -> DataFrame:
    """Six measures per payment method, over all time.

    Rows are collapsed per order, then per customer, so that orders and customers of a
    method are counted without a distinct count and no row is expanded for a second one.
    """
    source = as_sales(sales)
    rows = per_customer(
        active(source.per_order("payment_type")), "payment_type", unique_orders=source.unique_orders
    )
    turnover, paid = F.sum("payment_value"), source.amount_kind("payment_value")
    orders, customers = F.sum("orders"), F.count("customer_id")
    return (
        rows.groupBy("payment_type")
        .agg(
            turnover.alias("turnover"),
            F.sum("price").alias("net_revenue"),
            ratio(turnover, orders, paid).alias("aov"),
            ratio(turnover, customers, paid).alias("arpu"),
            orders.alias("orders"),
            customers.alias("customers"),
        )
        .orderBy(F.desc_nulls_first("turnover"))
    )
