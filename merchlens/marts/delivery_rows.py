"""Rows that delivery measures add up, from a stored mart or straight from raw tables.

Delivery averages weigh every item of an order. `items` carries that weight, so an
order is one row per seller place rather than one row per item.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.catalog import RawTables
from merchlens.marts.builders import delivered_orders, transit_days

_SELLER_KEYS = ("seller_city", "seller_state")


@dataclass(frozen=True)
class StoredDelivery:
    """The delivery mart as it is: one row per item of an order."""

    mart: DataFrame

    def rows(self, *keys: str) -> DataFrame:
        return self.mart.select("order_id", "delivery_days", *keys, F.lit(1).alias("items"))

    def order_count(self) -> Column:
        return F.count_distinct("order_id")


@dataclass(frozen=True)
class FactoredDelivery:
    """Delivery rows from the raw tables, one per order and combination of keys.

    Set `keys_enforced` only for tables whose loader found no repeated key: orders are
    then counted plainly, else distinct.
    """

    tables: RawTables
    keys_enforced: bool = False

    def rows(self, *keys: str) -> DataFrame:
        seller_keys = [key for key in keys if key in _SELLER_KEYS]
        customer_keys = [key for key in keys if key not in _SELLER_KEYS]
        orders = (
            delivered_orders(self.tables.orders)
            .select("order_id", "customer_id", transit_days().alias("delivery_days"))
            .join(self.tables.customers.select("customer_id", *customer_keys), "customer_id")
        )
        items = (
            self.tables.order_items.select("order_id", "seller_id")
            .join(self.tables.sellers.select("seller_id", *seller_keys), "seller_id")
            .groupBy("order_id", *seller_keys)
            .agg(F.count(F.lit(1)).alias("items"))
        )
        return orders.join(items, "order_id").select("order_id", "delivery_days", *keys, "items")

    def order_count(self) -> Column:
        return F.count("order_id") if self.keys_enforced else F.count_distinct("order_id")


Delivery = StoredDelivery | FactoredDelivery


def as_delivery(delivery: Delivery | RawTables | DataFrame) -> Delivery:
    if isinstance(delivery, RawTables):
        return FactoredDelivery(delivery)
    return StoredDelivery(delivery) if isinstance(delivery, DataFrame) else delivery
