from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from merchlens.fixed_values import METRIC_LABELS, PERIOD_LABELS
from merchlens.marts import FactoredSales, StoredSales, purchasing_power_mart, sales_mart
from merchlens.reports import profile, sales
from tests.fixtures import START, raw_tables, rows


@pytest.fixture(scope="module")
def fan_out(spark):
    """One order of two items and two payments."""
    return raw_tables(
        spark,
        orders=[{"order_id": "o"}],
        items=[{"order_id": "o", "price": 10}, {"order_id": "o", "price": 20}],
        payments=[{"order_id": "o", "payment_value": 25}, {"order_id": "o", "payment_value": 5}],
    )


def test_mart_pairs_items_with_payments(fan_out):
    assert sales_mart(fan_out).count() == 4


@pytest.mark.parametrize("stored", [False, True])
def test_sums_count_every_pair(fan_out, stored):
    source = sales_mart(fan_out) if stored else fan_out
    (month,) = rows(sales.sales_monthly(source))
    assert month == {
        "month": datetime(2018, 3, 1),
        "net_revenue": Decimal("60.00"),
        "turnover": Decimal("60.00"),
        "orders": 1,
    }


def test_order_without_payment_is_not_sold(spark):
    raw = raw_tables(
        spark, orders=[{"order_id": "o"}], items=[{"order_id": "o", "price": 10}], payments=[]
    )
    assert sales_mart(raw).count() == 0
    assert rows(sales.sales_monthly(raw)) == []


def test_status_filter_is_per_report(spark):
    statuses = ["delivered", "canceled", "unavailable", None]
    raw = raw_tables(
        spark,
        orders=[{"order_id": f"o{n}", "order_status": s} for n, s in enumerate(statuses)],
        items=[{"order_id": f"o{n}", "price": 1} for n in range(4)],
        payments=[{"order_id": f"o{n}", "payment_value": 1} for n in range(4)],
    )
    assert rows(sales.sales_monthly(raw))[0]["orders"] == 4
    assert rows(sales.kpi(raw, "orders", "last_month")) == [{"value": 1}]
    assert rows(sales.payment_methods(raw))[0]["orders"] == 1


@pytest.fixture(scope="module")
def months(spark):
    """The last order is canceled; two others lie around a month before it."""
    bought = {
        "last": datetime(2018, 3, 31, 5),
        "edge": datetime(2018, 2, 28, 5),
        "before": datetime(2018, 2, 28, 4, 59, 59),
        "year": datetime(2017, 3, 31, 5),
    }
    return raw_tables(
        spark,
        orders=[
            {
                "order_id": name,
                "order_purchase_timestamp": ts,
                "order_status": "canceled" if name == "last" else "delivered",
            }
            for name, ts in bought.items()
        ],
        items=[{"order_id": name, "price": 1} for name in bought],
        payments=[{"order_id": name, "payment_value": 1} for name in bought],
    )


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize(
    "period, orders", [("last_month", 1), ("last_quarter", 2), ("last_year", 3)]
)
def test_period_ends_at_the_last_purchase_of_any_status(months, stored, period, orders):
    source = sales_mart(months) if stored else months
    assert rows(sales.kpi(source, "orders", period)) == [{"value": orders}]


def test_recorded_last_purchase_is_used(months):
    source = StoredSales(sales_mart(months), latest=datetime(2018, 2, 28, 5))
    assert rows(sales.kpi(source, "orders", "last_month")) == [{"value": 2}]


def test_leap_day_is_clamped(spark):
    raw = raw_tables(
        spark,
        orders=[
            {"order_id": "a", "order_purchase_timestamp": datetime(2020, 2, 29)},
            {"order_id": "b", "order_purchase_timestamp": datetime(2019, 2, 28)},
            {"order_id": "c", "order_purchase_timestamp": datetime(2019, 2, 27, 23)},
        ],
        items=[{"order_id": o, "price": 1} for o in "abc"],
        payments=[{"order_id": o, "payment_value": 1} for o in "abc"],
    )
    assert rows(sales.kpi(raw, "orders", "last_year")) == [{"value": 2}]


def test_trend_is_by_month_for_the_year_and_by_monday_otherwise(months):
    by_month = rows(sales.kpi_trend(months, "orders", "last_year"))
    assert by_month == [
        {"period_date": datetime(2017, 3, 1), "value": 1},
        {"period_date": datetime(2018, 2, 1), "value": 2},
    ]
    by_week = rows(sales.kpi_trend(months, "orders", "last_month"))
    assert by_week == [{"period_date": datetime(2018, 2, 26), "value": 1}]


@pytest.mark.parametrize("stored", [False, True])
def test_unknown_metric_and_period(months, stored):
    source = sales_mart(months) if stored else months
    assert rows(sales.kpi(source, "x", "last_year")) == [{"value": None}]
    assert rows(sales.kpi(source, "orders", "x")) == [{"value": 0}]
    assert rows(sales.kpi(source, "turnover", "x")) == [{"value": None}]
    assert rows(sales.kpi(source, "aov", "x")) == [{"value": None}]
    assert rows(sales.kpi_by_state(source, "orders", "x")) == []
    assert rows(sales.kpi_by_state(source, "x", "last_year")) == [
        {"customer_state": "SP", "value": None}
    ]


def test_dashboard_labels_select_metric_and_period(months):
    by_label = sales.kpi(months, METRIC_LABELS["orders"], PERIOD_LABELS["last_quarter"])
    assert rows(by_label) == [{"value": 2}]


def test_top_categories_puts_null_metrics_and_breaks_ties(spark):
    raw = raw_tables(
        spark,
        orders=[{"order_id": o} for o in "abcd"],
        items=[
            {"order_id": "a", "product_id": "pa", "price": 5},
            {"order_id": "b", "product_id": "pb", "price": 5},
            {"order_id": "c", "product_id": "pc", "price": None},
            {"order_id": "d", "product_id": "pd", "price": 7},
        ],
        payments=[{"order_id": o, "payment_value": 1} for o in "abcd"],
        categories={"pa": "a", "pb": "b", "pc": "c", "pd": None},
    )
    found = rows(sales.top_categories(raw, "net_revenue", "last_year", top=3))
    assert [r["product_category"] for r in found] == ["c", None, "a"]
    assert [r["value"] for r in found] == [None, Decimal("7.00"), Decimal("5.00")]
    assert rows(sales.top_categories(sales_mart(raw), "net_revenue", "last_year", top=3)) == found


def test_three_average_order_values(spark):
    raw = raw_tables(
        spark,
        orders=[{"order_id": "a", "customer_id": "c"}, {"order_id": "b", "customer_id": "c"}],
        items=[
            {"order_id": "a", "price": 10},
            {"order_id": "a", "price": 20},
            {"order_id": "b", "price": 6},
        ],
        payments=[
            {"order_id": "a", "payment_value": 40},
            {"order_id": "b", "payment_value": 1, "payment_type": "boleto"},
            {"order_id": "b", "payment_value": 7, "payment_type": "voucher"},
        ],
    )
    assert rows(sales.kpi(raw, "aov", "last_year"))[0]["value"] == Decimal("44")
    assert rows(sales.kpi(raw, "arpu", "last_year"))[0]["value"] == Decimal("88")
    assert rows(profile.avg_order_value_items(raw.order_items))[0]["avg_order_value"] == 18
    methods = {r["payment_type"]: r for r in rows(sales.payment_methods(raw))}
    assert list(methods) == ["credit_card", "voucher", "boleto"]
    assert methods["credit_card"]["turnover"] == Decimal("80.00")
    assert methods["voucher"]["net_revenue"] == Decimal("6.00")
    assert methods["credit_card"]["customers"] == 1


@pytest.mark.parametrize("keys_enforced", [False, True])
def test_rows_are_one_per_order_and_keys(fan_out, keys_enforced):
    source = FactoredSales(fan_out, keys_enforced)
    (found,) = rows(source.rows("customer_state", "product_category", "payment_type"))
    assert (found["price"], found["payment_value"]) == (Decimal("60.00"), Decimal("60.00"))


def test_orphans_are_dropped_unless_keys_are_enforced(spark):
    raw = raw_tables(
        spark,
        orders=[{"order_id": "o"}],
        items=[{"order_id": "o", "price": 1}, {"order_id": "o", "price": 2, "seller_id": "gone"}],
        payments=[{"order_id": "o", "payment_value": 1}],
    )
    raw = raw.replace(sellers=raw.sellers.where("seller_id <> 'gone'"))
    assert rows(sales.kpi(raw, "net_revenue", "last_year")) == [{"value": Decimal("1.00")}]
    assert rows(sales.kpi(sales_mart(raw), "net_revenue", "last_year")) == [
        {"value": Decimal("1.00")}
    ]


def test_purchasing_power_holds_delivered_payments(spark):
    raw = raw_tables(
        spark,
        orders=[{"order_id": "a"}, {"order_id": "b", "order_status": "shipped"}],
        payments=[{"order_id": o, "payment_value": 1} for o in "aab"],
    )
    found = rows(purchasing_power_mart(raw))
    assert [r["order_id"] for r in found] == ["a", "a"]
    assert found[0]["customer_unique_id"] == "u-c-a"
    assert found[0]["order_purchase_timestamp"] == START
