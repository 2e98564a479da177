"""Sums without pairing equal sums over the pairs, on random tables."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchlens.marts import delivery_mart, sales_mart
from merchlens.reports import abc, logistics, sales
from tests.fixtures import START, raw_tables, rows

STATUSES = ("delivered", "shipped", "canceled", "unavailable", None)


def random_tables(spark, seed: int):
    """Orders with none to many items and payments, gaps, and items of lost sellers."""
    pick = random.Random(seed)
    orders, items, payments = [], [], []
    for n in range(40):
        order = f"o{n}"
        handed = START + timedelta(hours=pick.randrange(500))
        arrived = handed + timedelta(hours=pick.randrange(-60, 3000))
        orders.append(
            {
                "order_id": order,
                "customer_id": pick.choice(["c1", "c2", "c3", "c4", None]),
                "order_status": pick.choice(STATUSES),
                "order_purchase_timestamp": START + timedelta(hours=pick.randrange(9000)),
                "order_delivered_carrier_date": pick.choice([handed, handed, None]),
                "order_delivered_customer_date": pick.choice([arrived, arrived, None]),
            }
        )
        for _ in range(pick.choice([0, 1, 2, 5])):
            items.append(
                {
                    "order_id": order,
                    "product_id": pick.choice(["p1", "p2", "p3"]),
                    "seller_id": pick.choice(["s1", "s2", "lost"]),
                    "price": pick.choice([None, Decimal(pick.randrange(1, 9999)) / 100]),
                }
            )
        for _ in range(pick.choice([0, 1, 1, 3])):
            payments.append(
                {
                    "order_id": order,
                    "payment_type": pick.choice(["card", "voucher", None]),
                    "payment_value": Decimal(pick.randrange(1, 9999)) / 100,
                }
            )
    raw = raw_tables(
        spark,
        orders,
        items,
        payments,
        categories={"p1": "one", "p2": None, "p3": "three"},
        states={"c1": "SP", "c2": "RJ", "c3": None, "c4": "SP"},
    )
    return raw.replace(sellers=raw.sellers.where(F.col("seller_id") != "lost"))


def in_any_order(frame):
    return sorted(map(str, rows(frame)))


REPORTS = {
    "monthly": sales.sales_monthly,
    "methods": sales.payment_methods,
    "pareto": lambda s: abc.pareto(s, "product_category"),
    "pareto of cities": lambda s: abc.pareto(s, "seller_city"),
    **{
        f"{report.__name__} {metric}": lambda s, r=report, m=metric: r(s, m, "last_year")
        for report in (sales.kpi_by_state, sales.top_categories)
        for metric in ("turnover", "net_revenue", "orders", "arpu")
    },
}


@pytest.fixture(scope="module", params=[1, 2])
def tables(spark, request):
    return random_tables(spark, request.param)


@pytest.mark.parametrize("name", REPORTS)
def test_sales_reports_on_raw_tables_equal_those_on_the_mart(tables, name):
    report = REPORTS[name]
    assert in_any_order(report(tables)) == in_any_order(report(sales_mart(tables)))


@pytest.mark.parametrize(
    "report",
    [
        logistics.delivery_by_state,
        logistics.delivery_histogram,
        logistics.fastest_cities,
        logistics.late_share,
        logistics.problem_routes,
    ],
)
def test_delivery_reports_on_raw_tables_equal_those_on_the_mart(tables, report):
    assert in_any_order(report(tables)) == in_any_order(report(delivery_mart(tables)))


def test_category_revenue_equals_a_plain_loop(tables):
    """The pairs, made one by one."""
    orders = {o["order_id"]: o for o in rows(tables.orders)}
    customers = {c["customer_id"] for c in rows(tables.customers)}
    sellers = {s["seller_id"] for s in rows(tables.sellers)}
    category = {p["product_id"]: p["product_category"] for p in rows(tables.products)}
    paid = defaultdict(list)
    for payment in rows(tables.payments):
        paid[payment["order_id"]].append(payment["payment_value"])
    revenue, turnover, sold = defaultdict(Decimal), defaultdict(Decimal), defaultdict(set)
    for item in rows(tables.order_items):
        order = orders[item["order_id"]]
        if order["customer_id"] not in customers or item["seller_id"] not in sellers:
            continue
        if order["order_status"] in (None, "canceled", "unavailable"):
            continue
        for value in paid[item["order_id"]]:
            key = category[item["product_id"]]
            revenue[key] += item["price"] or 0
            turnover[key] += value
            sold[key].add(item["order_id"])
    found = {r["product_category"]: r for r in rows(abc.pareto(tables, "product_category"))}
    assert {k: (r["revenue"] or 0, r["cash_flow"], r["orders"]) for k, r in found.items()} == {
        k: (revenue[k], turnover[k], len(sold[k])) for k in sold
    }


def test_methods_count_orders_that_come_with_several_customers(spark):
    """An order id held by two customers is one order and two customers of its method."""
    raw = raw_tables(
        spark,
        orders=[
            {"order_id": "a", "customer_id": "c1"},
            {"order_id": "a", "customer_id": "c2"},
            {"order_id": "b", "customer_id": "c2"},
            {"order_id": "b", "customer_id": "c2"},
            {"order_id": "d", "customer_id": "c1"},
        ],
        items=[{"order_id": o, "price": 10} for o in "aabd"],
        payments=[
            {"order_id": o, "payment_type": kind, "payment_value": 5}
            for o, kind in (("a", "card"), ("a", "voucher"), ("b", "card"), ("d", None), ("d", "card"))
        ],
    )
    pairs = sales_mart(raw)
    expected = {
        r.payment_type: (r.orders, r.customers, r.turnover, r.net_revenue)
        for r in pairs.groupBy("payment_type")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("customer_id").alias("customers"),
            F.sum("payment_value").alias("turnover"),
            F.sum("price").alias("net_revenue"),
        )
        .collect()
    }
    for source in (raw, pairs):
        found = rows(sales.payment_methods(source))
        assert {
            r["payment_type"]: (r["orders"], r["customers"], r["turnover"], r["net_revenue"]) for r in found
        } == expected
    assert expected["card"][:2] == (3, 2)
