"""The joined marts, and the rows that reports measure."""

from merchlens.marts.builders import delivery_mart, purchasing_power_mart, sales_mart
from merchlens.marts.delivery_rows import FactoredDelivery, StoredDelivery, as_delivery
from merchlens.marts.sales_rows import FactoredSales, StoredSales, as_sales

__all__ = [
    "FactoredDelivery",
    "FactoredSales",
    "StoredDelivery",
    "StoredSales",
    "as_delivery",
    "as_sales",
    "delivery_mart",
    "purchasing_power_mart",
    "sales_mart",
]
