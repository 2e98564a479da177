"""Metrics that sales reports can be asked for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchlens.fixed_values import METRIC_LABELS
from merchlens.functions import ratio
from merchlens.marts.sales_rows import Sales

METRICS = tuple(METRIC_LABELS)


def metric_key(name: str) -> str | None:
    """Key of a metric given by key or dashboard label; None when unknown."""
    by_label = {label: key for key, label in METRIC_LABELS.items()}
    return name if name in METRIC_LABELS else by_label.get(name)


def metric_value(name: str, sales: Sales) -> Column:
    """Aggregate of one metric. Only the one asked for reaches the plan.

    An unknown metric has the value NULL.
    """
    turnover, net_revenue = F.sum("payment_value"), F.sum("price")
    paid = sales.amount_kind("payment_value")
    orders, customers = sales.order_count(), F.count_distinct("customer_id")
    values = {
        "turnover": turnover,
        "net_revenue": net_revenue,
        "orders": orders,
        "customers": customers,
        "aov": ratio(turnover, orders, paid),
        "arpu": ratio(turnover, customers, paid),
    }
    return values.get(metric_key(name), F.lit(None).cast("decimal(38,6)"))
