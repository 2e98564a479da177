from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from merchlens.catalog import TABLES, dependants, load_waves
from merchlens.operators import checks
from merchlens.operators.table_profile import TableProfile
from merchlens.reports import profile
from tests.fixtures import frame, raw_tables, rows


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def test_repeated_keys_are_reported(spark):
    assert rows(checks.pk_check(keys(spark, ["1", "1", "2"]), "id")) == [
        {"unique_keys": 2, "rows": 3, "verdict": "Duplicates"}
    ]
    assert rows(checks.pk_check(keys(spark, ["1", "2"]), "id"))[0]["verdict"] == "Unique"
    assert rows(checks.pk_check(keys(spark, ["1", None]), "id"))[0]["verdict"] == "Duplicates"


def test_orphans_are_counted_once_per_key(spark):
    parent = keys(spark, ["1", "2"])
    assert rows(checks.fk_check(keys(spark, ["1", "2", "9", "9"]), parent, "id")) == [
        {"orphans": 1, "verdict": "1 orphans"}
    ]
    assert rows(checks.fk_check(keys(spark, ["1", None]), parent, "id"))[0]["orphans"] == 1
    assert rows(checks.fk_check(keys(spark, ["1", "1"]), parent, "id"))[0]["verdict"] == "OK"


def test_missing_values_list_only_columns_with_gaps(spark):
    data = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a int, b string")
    assert rows(checks.missing_values(data)) == [
        {"column_name": "b", "missing": 1, "percent": 33.33}
    ]


def test_missing_percent_is_rounded_half_even(spark):
    data = spark.range(800).selectExpr("case when id > 0 then id end as a")
    assert rows(checks.missing_values(data))[0]["percent"] == 0.12


def test_shapes_and_overview(spark):
    data = spark.createDataFrame([(1, None), (2, "x")], "a int, b string").coalesce(1)
    assert rows(checks.table_shapes({"t": data, "u": data.limit(0)})) == [
        {"table_name": "t", "rows": 2, "cols": 2},
        {"table_name": "u", "rows": 0, "cols": 2},
    ]
    assert rows(checks.schema_overview(data)) == [
        {"column_name": "a", "data_type": "int", "preview": ["1", "2"]},
        {"column_name": "b", "data_type": "string", "preview": ["NULL", "x"]},
    ]


def profiled(spark):
    rows_ = [(1, "x", datetime(2018, 1, 1)), (2, None, None), (10, "y", datetime(2018, 3, 1)), (9, "x", None)]
    return spark.createDataFrame(rows_, "n int, kind string, at timestamp_ntz")


def test_a_profile_answers_all_checks(spark):
    data = profiled(spark)
    found = TableProfile.of(data, ("kind",))
    assert rows(found.shape()) == [{"rows": 4, "cols": 3}]
    assert rows(found.missing_values()) == rows(checks.missing_values(data))
    assert rows(found.ranges(["at"])) == rows(checks.date_ranges(data, ["at"]))
    assert rows(found.value_counts("kind")) == rows(checks.value_counts(data, "kind"))
    # Bounds are those of the type: 10 is larger than 9.
    overview = {r["column_name"]: (r["smallest"], r["largest"], r["missing"]) for r in rows(found.overview())}
    assert overview["n"] == ("1", "10", 0) and overview["kind"] == ("x", "y", 1)
    assert overview["at"] == ("2018-01-01 00:00:00", "2018-03-01 00:00:00", 2)


def test_profiles_of_parts_merge_into_that_of_the_whole(spark):
    data = profiled(spark)
    parts = [data.where("n < 2"), data.where("n between 2 and 9"), data.where("n > 9"), data.limit(0)]
    whole = TableProfile.of(data, ("kind",))
    merged = TableProfile.of(parts[0], ("kind",)).merged(*(TableProfile.of(p, ("kind",)) for p in parts[1:]))
    for check in (TableProfile.shape, TableProfile.overview, TableProfile.missing_values):
        assert rows(check(merged)) == rows(check(whole))
    assert rows(merged.value_counts("kind")) == rows(whole.value_counts("kind"))
    with pytest.raises(ValueError):
        whole.merged(TableProfile.of(data))


def test_a_profile_of_no_rows(spark):
    empty = TableProfile.of(profiled(spark).limit(0))
    assert rows(empty.shape()) == [{"rows": 0, "cols": 3}]
    assert [r["missing"] for r in rows(empty.overview())] == [0, 0, 0]
    assert rows(empty.missing_values()) == []


def test_key_checks_tell_repeats_gaps_and_orphans(spark):
    raw = raw_tables(
        spark,
        orders=[{"order_id": "a"}, {"order_id": "b"}, {"order_id": "b"}, {"order_id": None}],
        items=[{"order_id": "a", "price": 1}, {"order_id": "z", "price": 1}, {"order_id": "z", "price": 1}],
        payments=[{"order_id": "a", "payment_value": 1}],
    )
    found = {r["table_name"]: r for r in rows(checks.key_checks(raw))}
    orders = {"rows": 4, "unique_keys": 2, "duplicate_rows": 1, "null_keys": 1, "orphan_keys": 0}
    assert found["orders"] == {"table_name": "orders", **orders}
    assert found["order_items"]["orphan_keys"] == 1 and found["payments"]["orphan_keys"] == 0


def test_value_counts_leave_out_null(spark):
    data = keys(spark, ["a", "b", "b", None])
    assert rows(checks.value_counts(data, "id")) == [{"id": "b", "rows": 2}, {"id": "a", "rows": 1}]


def test_date_ranges(spark):
    first, last = datetime(2017, 1, 2, 3), datetime(2018, 1, 1)
    orders = frame(
        spark,
        "orders",
        [
            {"order_id": "a", "order_purchase_timestamp": last},
            {"order_id": "b", "order_purchase_timestamp": first},
        ],
    )
    found = rows(checks.date_ranges(orders))
    assert found[0] == {
        "column_name": "order_purchase_timestamp",
        "earliest": first,
        "latest": last,
    }
    assert len(found) == 5 and found[1]["earliest"] is None


def test_base_figures(spark):
    raw = raw_tables(
        spark,
        orders=[{"order_id": "a"}, {"order_id": "b"}],
        items=[
            {"order_id": "a", "product_id": "x", "price": "1234.50"},
            {"order_id": "b", "product_id": "y", "price": 5},
            {"order_id": "b", "product_id": "z", "price": None},
        ],
        categories={"x": "big", "y": "small", "z": None},
    )
    (total,) = rows(profile.total_revenue(raw.order_items))
    assert total == {"total_revenue": Decimal("1242.50"), "total_text": "1,242.50"}
    (mean,) = rows(profile.avg_order_value_items(raw.order_items))
    assert mean["avg_text"] == "619.75"
    top = rows(profile.top_categories_items(raw.order_items, raw.products))
    assert [r["product_category"] for r in top] == ["big", "small"]
    counts = {r["entity"]: r["entities"] for r in rows(profile.entity_counts(raw))}
    assert counts == {"customers": 2, "sellers": 1, "products": 4}


def test_ratings_are_ordered_by_rating(spark):
    reviews = spark.createDataFrame([(5,), (1,), (5,), (None,)], "star_rating int")
    assert rows(profile.rating_distribution(reviews)) == [
        {"star_rating": 1, "rows": 1},
        {"star_rating": 5, "rows": 2},
    ]


def test_tables_load_after_those_they_reference():
    assert [sorted(wave) for wave in load_waves(TABLES)] == [
        ["customers", "geolocation", "products", "sellers"],
        ["orders"],
        ["order_items", "payments"],
    ]
    assert dependants(TABLES, "customers") == ["orders", "order_items", "payments"]
    assert dependants(TABLES, "sellers") == ["order_items"]
    assert dependants(TABLES, "geolocation") == []
