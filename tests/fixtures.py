"""Small hand-made raw tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from merchlens.catalog import TABLES, RawTables

START = datetime(2018, 3, 1, 12)


def frame(spark, table: str, rows: list[dict]):
    """Rows of a raw table; columns not given are NULL."""
    columns = TABLES[table].columns
    schema = ", ".join(
        f"{name} {'string' if kind.startswith('varchar') else kind}"
        for name, kind in columns.items()
    )
    for row in rows:
        assert set(row) <= set(columns), row
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in rows], schema)


def raw_tables(spark, orders=(), items=(), payments=(), categories=None, states=None):
    """A model around the given orders, items and payments.

    Orders need `order_id`; items `order_id` and `price` and may name a `product_id`
    and `seller_id`; every product, seller and customer they name exists.
    """
    from decimal import Decimal

    orders = [
        {
            "customer_id": f"c-{o['order_id']}",
            "order_status": "delivered",
            "order_purchase_timestamp": START,
            **o,
        }
        for o in orders
    ]
    numbered: dict[str, int] = {}

    def number(order: str) -> int:
        numbered[order] = numbered.get(order, 0) + 1
        return numbered[order]

    items = [
        {
            "product_id": "p",
            "seller_id": "s",
            "order_item_id": number(i["order_id"]),
            "freight_value": Decimal("1.00"),
            **i,
            "price": None if i["price"] is None else Decimal(str(i["price"])),
        }
        for i in items
    ]
    numbered.clear()
    payments = [
        {
            "payment_type": "credit_card",
            "payment_installments": 1,
            "payment_sequential": number(p["order_id"]),
            **p,
            "payment_value": Decimal(str(p["payment_value"])),
        }
        for p in payments
    ]
    customer_ids = sorted({o["customer_id"] for o in orders if o["customer_id"] is not None})
    categories, states = categories or {}, states or {}
    return RawTables(
        customers=frame(
            spark,
            "customers",
            [
                {
                    "customer_id": c,
                    "customer_unique_id": f"u-{c}",
                    "customer_city": f"city-{c}",
                    "customer_state": states.get(c, "SP"),
                }
                for c in customer_ids
            ],
        ),
        sellers=frame(
            spark,
            "sellers",
            [
                {"seller_id": s, "seller_city": f"city-{s}", "seller_state": "RJ"}
                for s in sorted({i["seller_id"] for i in items} | {"s"})
            ],
        ),
        products=frame(
            spark,
            "products",
            [
                {"product_id": p, "product_category": categories.get(p, p)}
                for p in sorted({i["product_id"] for i in items} | {"p"})
            ],
        ),
        orders=frame(spark, "orders", orders),
        order_items=frame(spark, "order_items", items),
        payments=frame(spark, "payments", payments),
    )


def delivered(hours: list[float], **more) -> list[dict]:
    """Orders whose delivery took the given hours."""
    return [
        {
            "order_id": f"o{n:03d}",
            "order_delivered_carrier_date": START,
            "order_delivered_customer_date": START + timedelta(hours=h),
            **more,
        }
        for n, h in enumerate(hours)
    ]


def rows(frame) -> list[dict]:
    return [row.asDict() for row in frame.collect()]


def categories_with_revenue(spark, revenues: dict):
    """One order with one item and one payment for each category and price."""
    n = [(f"o{i}", f"p{i}", name, price) for i, (name, price) in enumerate(revenues.items())]
    return raw_tables(
        spark,
        orders=[{"order_id": o} for o, *_ in n],
        items=[{"order_id": o, "product_id": p, "price": price} for o, p, _, price in n],
        payments=[{"order_id": o, "payment_value": 1} for o, *_ in n],
        categories={p: name for _, p, name, _ in n},
    )
