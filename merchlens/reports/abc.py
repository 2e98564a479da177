"""Pareto and ABC reports over any key of the sales rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from merchlens.fixed_values import ABC_A_UNTIL, ABC_B_UNTIL
from merchlens.functions import percent, ratio, with_percent
from merchlens.marts.sales_rows import as_sales
from merchlens.operators.periods import active
from merchlens.operators.running_total import running_total


def revenue_by(sales, key: str) -> DataFrame:
    """Revenue, turnover and orders of each key value."""
    source = as_sales(sales)
    return (
        active(source.rows(key))
        .groupBy(key)
        .agg(
            F.sum("price").alias("revenue"),
            F.sum("payment_value").alias("cash_flow"),
            source.order_count().alias("orders"),
        )
    )


def pareto(sales, key: str) -> DataFrame:
    """Revenue of each key value with its share and its cumulative share.

    Building the report runs nothing, and running it reads the sales rows once: totals are
    put together from the shuffled rows per key, however many there are.
    """
    kind = as_sales(sales).amount_kind("price")
    return (
        running_total(revenue_by(sales, key), "revenue")
        .withColumnRenamed("overall", "total_revenue")
        .select(
            key,
            "revenue",
            "total_revenue",
            percent(F.col("revenue"), F.col("total_revenue"), 3, kind).alias("pct_total"),
            percent(F.col("running"), F.col("total_revenue"), 3, kind).alias("cumulative_pct"),
            "cash_flow",
            "orders",
            ratio(F.col("revenue"), F.col("orders"), kind).alias("aov"),
        )
    )


def abc_group() -> Column:
    """Class by the rounded cumulative share; a missing share is class C."""
    share = F.col("cumulative_pct")
    return F.when(share <= ABC_A_UNTIL, "A").when(share <= ABC_B_UNTIL, "B").otherwise("C")


def abc_classes(
    sales, key: str, by_label: bool = True, with_amount: bool = False
) -> DataFrame:
    """Summary of each class: members, revenue, turnover, orders and mean order value.

    Rows are ordered by the text of the revenue label, or by class when not
    `by_label`. The label sorts as text; `with_amount` adds the revenue as a number and
    sorts by it, largest first.
    """
    kind = as_sales(sales).amount_kind("price")
    classes = (
        pareto(sales, key)
        .groupBy(abc_group().alias("abc_group"))
        .agg(
            F.count(key).alias("member_count"),
            F.sum("revenue").alias("class_revenue"),
            F.sum("cash_flow").alias("cash_flow"),
            F.sum("orders").alias("orders"),
            F.avg("aov").alias("aov"),
        )
    )
    # Three classes at most, so a window over all rows holds three rows.
    every = Window.partitionBy()
    members, revenue = F.col("member_count"), F.col("class_revenue")
    labelled = classes.select(
        "abc_group",
        with_percent(members, percent(members, F.sum(members).over(every), 2, T.LongType())).alias("members"),
        with_percent(revenue, percent(revenue, F.sum(revenue).over(every), 2, kind)).alias("revenue"),
        "cash_flow",
        "orders",
        "aov",
        *([revenue.alias("revenue_amount")] if with_amount else []),
    )
    if with_amount:
        return labelled.orderBy(F.desc_nulls_first("revenue_amount"), "abc_group")
    if by_label:
        return labelled.orderBy(F.asc_nulls_last("revenue"))
    return labelled.orderBy("abc_group", F.desc_nulls_first("cash_flow"))


def abc_revenue(sales, key: str) -> DataFrame:
    """Revenue of each class."""
    return (
        pareto(sales, key)
        .groupBy(abc_group().alias("abc_group"))
        .agg(F.sum("revenue").alias("revenue"))
    )


def abc_detail(sales, key: str) -> DataFrame:
    """Every key value in its class, with its share of all revenue."""
    kind = as_sales(sales).amount_kind("price")
    share = percent(F.col("revenue"), F.col("total_revenue"), 2, kind)
    return (
        pareto(sales, key)
        .select(
            abc_group().alias("abc_group"),
            key,
            with_percent(F.col("revenue"), share).alias("revenue"),
            "cash_flow",
            "orders",
            "aov",
        )
        .orderBy("abc_group", F.desc_nulls_first("cash_flow"))
    )
