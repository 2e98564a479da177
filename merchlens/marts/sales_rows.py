"""Rows that sales measures add up, from a stored mart or straight from raw tables.

The sales mart pairs every item of an order with every payment of it, and all
sales figures are sums over those pairs. Pairs need not exist to be summed: over
an order's pairs, the prices add up to (sum of prices) x (number of payments) and
the payments to (sum of payments) x (number of items). `FactoredSales` therefore
collapses items and payments per order before it joins them. The figures are the
mart's, and an order with a great many items and payments costs its rows, not
their product.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.catalog import RawTables

_ORDER = ("order_id", "customer_id", "order_purchase_timestamp", "order_status")
_CUSTOMER_KEYS = ("customer_city", "customer_state")
_PRODUCT_KEYS = ("product_id", "product_category")
_SELLER_KEYS = ("seller_id", "seller_city", "seller_state")
_PAYMENT_KEYS = ("payment_type",)
STORED_MONTH = "purchase_month"


def _among(keys: tuple[str, ...], known: tuple[str, ...]) -> list[str]:
    return [key for key in keys if key in known]


# Picks rows by the columns of their orders, before anything is joined or added up.
OrderFilter = Callable[[DataFrame], DataFrame]


def _every(orders: DataFrame) -> DataFrame:
    return orders


def _literal(time: datetime) -> Column:
    return F.lit(time.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class StoredSales:
    """The sales mart as it is: one row per item and payment of an order.

    `latest` is the last purchase in the mart when the writer recorded it; else it
    is looked up. A `purchase_month` column, when there is one, prunes files. Set
    `unique_orders` when every order has one customer, time and status.
    """

    mart: DataFrame
    latest: datetime | None = None
    unique_orders: bool = False

    def rows(self, *keys: str, orders: OrderFilter = _every) -> DataFrame:
        month = [STORED_MONTH] if STORED_MONTH in self.mart.columns else []
        own = [key for key in keys if key not in _ORDER]
        return orders(self.mart.select(*_ORDER, *month, *own, "price", "payment_value"))

    def per_order(self, *keys: str) -> DataFrame:
        """Rows collapsed to one for each order and combination of keys."""
        group = [c for c in self.rows(*keys).columns if c not in ("price", "payment_value")]
        return (
            self.rows(*keys)
            .groupBy(*group)
            .agg(F.sum("price").alias("price"), F.sum("payment_value").alias("payment_value"))
        )

    def order_count(self) -> Column:
        return F.count_distinct("order_id")

    def amount_kind(self, column: str) -> T.DataType:
        return self.mart.schema[column].dataType

    def last_purchase(self) -> Column:
        if self.latest is not None:
            return _literal(self.latest)
        return self.mart.agg(F.max("order_purchase_timestamp")).scalar()


@dataclass(frozen=True)
class FactoredSales:
    """Sales rows from the raw tables, one per order and combination of keys.

    Set `keys_enforced` only for tables whose loader found no repeated key and no orphan:
    joins that would merely look for a parent row are then left out, and orders are
    counted plainly. On other tables a repeated parent repeats rows, as it does in the
    mart, and orders are counted distinct. `latest` is the last purchase that has an item
    and a payment when a load recorded it; else it is looked up among all of them.
    """

    tables: RawTables
    keys_enforced: bool = False
    latest: datetime | None = None

    def rows(self, *keys: str, orders: OrderFilter = _every) -> DataFrame:
        """Items and payments of filtered-out orders are dropped before they are added up."""
        item_keys = _among(keys, _PRODUCT_KEYS + _SELLER_KEYS)
        payment_keys = _among(keys, _PAYMENT_KEYS)
        items, payments = self._items(keys), self.tables.payments
        if orders is not _every:
            chosen = orders(self.tables.orders.select(*_ORDER)).select("order_id")
            items = items.join(chosen, "order_id", "left_semi")
            payments = payments.join(chosen, "order_id", "left_semi")
        items = items.groupBy("order_id", *item_keys).agg(
            F.sum("price").alias("item_price"), F.count(F.lit(1)).alias("item_rows")
        )
        payments = payments.groupBy("order_id", *payment_keys).agg(
            F.sum("payment_value").alias("paid"), F.count(F.lit(1)).alias("payment_rows")
        )
        own = [key for key in keys if key not in _ORDER]
        return (
            self._orders(keys, orders)
            .join(payments, "order_id")
            .join(items, "order_id")
            .select(
                *_ORDER,
                *own,
                (F.col("item_price") * F.col("payment_rows")).alias("price"),
                (F.col("paid") * F.col("item_rows")).alias("payment_value"),
            )
        )

    per_order = rows

    @property
    def unique_orders(self) -> bool:
        """With unique keys each order appears once per combination of report keys."""
        return self.keys_enforced

    def order_count(self) -> Column:
        return F.count("order_id") if self.unique_orders else F.count_distinct("order_id")

    def amount_kind(self, column: str) -> T.DataType:
        table = self.tables.order_items if column == "price" else self.tables.payments
        return table.schema[column].dataType

    def last_purchase(self) -> Column:
        if self.latest is not None:
            return _literal(self.latest)
        return self.sold_orders().agg(F.max("order_purchase_timestamp")).scalar()

    def sold_orders(self) -> DataFrame:
        """Orders that have a payment and an item; nothing is added up for them."""
        sold = self._items(()).select("order_id")
        orders = self._orders((), _every)
        for held in (self.tables.payments.select("order_id"), sold):
            orders = orders.join(held, "order_id", "left_semi")
        return orders

    def _orders(self, keys: tuple[str, ...], chosen: OrderFilter) -> DataFrame:
        return self._with_parent(
            chosen(self.tables.orders.select(*_ORDER)),
            self.tables.customers,
            "customer_id",
            _among(keys, _CUSTOMER_KEYS),
        )

    def _items(self, keys: tuple[str, ...]) -> DataFrame:
        items = self.tables.order_items.select("order_id", "product_id", "seller_id", "price")
        product_keys, seller_keys = _among(keys, _PRODUCT_KEYS), _among(keys, _SELLER_KEYS)
        items = self._with_parent(items, self.tables.products, "product_id", product_keys)
        return self._with_parent(items, self.tables.sellers, "seller_id", seller_keys)

    def _with_parent(
        self, child: DataFrame, parent: DataFrame, key: str, columns: list[str]
    ) -> DataFrame:
        columns = [column for column in columns if column != key]
        if self.keys_enforced and not columns:
            return child.where(F.col(key).isNotNull())
        return child.join(parent.select(key, *columns), key)


Sales = StoredSales | FactoredSales


def as_sales(sales: Sales | RawTables | DataFrame) -> Sales:
    if isinstance(sales, RawTables):
        return FactoredSales(sales)
    return StoredSales(sales) if isinstance(sales, DataFrame) else sales
