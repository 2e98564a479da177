"""Trailing periods that end at the last purchase in the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.fixed_values import INACTIVE_STATUSES, PERIOD_LABELS, PERIOD_MONTHS
from merchlens.functions import month_start, week_start
from merchlens.marts.sales_rows import STORED_MONTH, Sales

PERIODS = tuple(PERIOD_LABELS)


def period_key(name: str) -> str | None:
    """Key of a period given by key or dashboard label; None when unknown."""
    by_label = {label: key for key, label in PERIOD_LABELS.items()}
    return name if name in PERIOD_LABELS else by_label.get(name)


def active(rows: DataFrame) -> DataFrame:
    """Rows of orders that count as sales; a NULL status does not."""
    return rows.where(~F.col("order_status").isin(*INACTIVE_STATUSES))


def sold_in(sales: Sales, period: str, *keys: str) -> DataFrame:
    """Sales rows of active orders bought within the period.

    Orders are chosen first, so that raw items and payments of others are dropped
    before they are added up, and stored months outside the period are not read.
    """
    return sales.rows(*keys, orders=lambda orders: in_period(active(orders), sales, period))


def in_period(rows: DataFrame, sales: Sales, period: str) -> DataFrame:
    """Rows bought within the period; none when the period is unknown.

    The period ends at the last purchase of all sales, whatever its status. A
    month-end start is clamped to the length of its month.
    """
    key = period_key(period)
    if key is None:
        return rows.where(F.lit(None).cast("boolean"))
    months = F.make_ym_interval(F.lit(0), F.lit(PERIOD_MONTHS[key]))
    start = sales.last_purchase() - months
    if STORED_MONTH in rows.columns:
        rows = rows.where(F.col(STORED_MONTH) >= F.trunc(start, "month"))
    return rows.where(F.col("order_purchase_timestamp") >= start)


def period_bucket(period: str) -> Column:
    """Month of purchase for the year, week of purchase for anything else."""
    unit = month_start if period_key(period) == "last_year" else week_start
    return unit(F.col("order_purchase_timestamp"))
