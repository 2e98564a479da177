from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from merchlens.fixed_values import DELIVERY_BUCKET_BEYOND, DELIVERY_BUCKETS
from merchlens.marts import delivery_mart, sales_mart
from merchlens.reports import logistics
from tests.fixtures import START, delivered, raw_tables, rows

LABELS = [label for _, label in DELIVERY_BUCKETS] + [DELIVERY_BUCKET_BEYOND]


def orders_taking(spark, hours, **more):
    orders = delivered(hours, **more)
    return raw_tables(
        spark, orders=orders, items=[{"order_id": o["order_id"], "price": 1} for o in orders]
    )


@pytest.mark.parametrize(
    "hours, day, hour, text",
    [
        (-43, -1, -19, "-1 days -19 hours"),
        (23, 0, 23, "0 days 23 hours"),
        (-23, 0, -23, "0 days -23 hours"),
        (24 * 121 + 7, 121, 7, "121 days 7 hours"),
    ],
)
def test_difference_parts_are_cut_toward_zero(spark, hours, day, hour, text):
    (row,) = rows(delivery_mart(orders_taking(spark, [hours])))
    assert (row["delivery_days"], row["delivery_hours"], row["delivery_time"]) == (day, hour, text)


def test_delivery_keeps_unpaid_orders_of_any_status(spark):
    raw = orders_taking(spark, [30], order_status="canceled")
    assert delivery_mart(raw).count() == 1
    assert sales_mart(raw).count() == 0


def test_orders_without_both_dates_are_left_out(spark):
    orders = delivered([24, 24, 24])
    orders[0]["order_delivered_carrier_date"] = None
    orders[1]["order_delivered_customer_date"] = None
    raw = raw_tables(
        spark, orders=orders, items=[{"order_id": o["order_id"], "price": 1} for o in orders]
    )
    assert delivery_mart(raw).count() == 1
    assert rows(logistics.delivery_histogram(raw)) == [
        {"delivery_bucket": LABELS[1], "deliveries": 1}
    ]


@pytest.mark.parametrize("stored", [False, True])
def test_bucket_edges(spark, stored):
    days = [-1, 0, 2, 3, 6, 7, 13, 14, 29, 30, 59, 60, 89, 90]
    raw = orders_taking(spark, [24 * d for d in days])
    found = rows(logistics.delivery_histogram(delivery_mart(raw) if stored else raw))
    assert [r["delivery_bucket"] for r in found] == LABELS
    assert [r["deliveries"] for r in found] == [1, 2, 2, 2, 2, 2, 2, 1]


def test_less_than_a_day_early_is_in_the_second_bucket(spark):
    raw = orders_taking(spark, [-23, 23, -24])
    assert rows(logistics.delivery_histogram(raw)) == [
        {"delivery_bucket": LABELS[0], "deliveries": 1},
        {"delivery_bucket": LABELS[1], "deliveries": 2},
    ]


@pytest.mark.parametrize("stored", [False, True])
def test_late_share_is_cut_to_a_whole_percent(spark, stored):
    raw = orders_taking(spark, [24 * 15] * 2 + [24 * 14] * 11)
    found = rows(logistics.late_share(delivery_mart(raw) if stored else raw))
    assert float(found[0]["late_share"]) == 0.15


def test_averages_weigh_items_except_in_the_trend(spark):
    orders = delivered([24, 24 * 4])
    raw = raw_tables(
        spark,
        orders=orders,
        items=[{"order_id": "o000", "price": 1}] * 1 + [{"order_id": "o001", "price": 1}] * 2,
    )
    for source in (raw, delivery_mart(raw)):
        assert rows(logistics.delivery_by_state(source)) == [
            {"customer_state": "SP", "avg_delivery_days": 3.0}
        ]
        assert rows(logistics.fastest_cities(source)) == [
            {"seller_city": "city-s", "avg_delivery_days": 3.0, "deliveries": 2}
        ]
    assert rows(logistics.delivery_trend(raw.orders)) == [
        {"month": datetime(2018, 3, 1), "avg_delivery_days": 2.5}
    ]


def test_trend_is_by_month_of_delivery(spark):
    raw = orders_taking(spark, [24 * 40])
    month = (START + timedelta(days=40)).replace(day=1, hour=0)
    assert rows(logistics.delivery_trend(raw.orders)) == [
        {"month": month, "avg_delivery_days": 40.0}
    ]


@pytest.mark.parametrize("stored", [False, True])
def test_problem_routes_exceed_the_limit(spark, stored):
    orders = delivered([24 * 90, 24 * 91, 24 * 95], customer_id="c")
    raw = raw_tables(
        spark,
        orders=orders,
        items=[
            {"order_id": "o000", "price": 1, "seller_id": "s1"},
            {"order_id": "o001", "price": 1, "seller_id": "s2"},
            {"order_id": "o002", "price": 1, "seller_id": "s2"},
            {"order_id": "o002", "price": 1, "seller_id": "s2"},
        ],
    )
    found = rows(logistics.problem_routes(delivery_mart(raw) if stored else raw))
    assert found == [
        {
            "route": "city-s2 -> city-c",
            "seller_state": "RJ",
            "customer_state": "SP",
            "avg_delivery_days": (91 + 95 + 95) / 3,
            "orders": 2,
        }
    ]


@pytest.mark.parametrize("stored", [False, True])
def test_routes_that_read_the_same_are_one(spark, stored):
    """Two city pairs give one text, and an order sold by both sellers counts once."""
    orders = delivered([24 * 100], customer_id="c")
    raw = raw_tables(
        spark,
        orders=orders,
        items=[
            {"order_id": "o000", "price": 1, "seller_id": "s1"},
            {"order_id": "o000", "price": 1, "seller_id": "s2"},
        ],
    )
    raw = raw.replace(customers=raw.customers.selectExpr(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "cast(null as string) customer_city", "customer_state",
    ))
    found = rows(logistics.problem_routes(delivery_mart(raw) if stored else raw))
    assert [(r["route"], r["orders"]) for r in found] == [(None, 1)]


def test_fastest_cities_are_limited_and_ordered(spark):
    raw = raw_tables(
        spark,
        orders=delivered([24 * d for d in (5, 1, 1, 3)]),
        items=[
            {"order_id": f"o{n:03d}", "price": 1, "seller_id": s} for n, s in enumerate("dcba")
        ],
    )
    found = rows(logistics.fastest_cities(raw, top=3))
    assert [r["seller_city"] for r in found] == ["city-b", "city-c", "city-a"]


def test_median_is_over_orders(spark):
    raw = orders_taking(spark, [24, 24 * 2, 24 * 2, 24 * 9])
    assert rows(logistics.delivery_median(raw.orders)) == [{"median_delivery_days": 2.0}]
