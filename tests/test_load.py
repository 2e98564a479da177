from __future__ import annotations

import re
import threading
import uuid
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from merchlens.catalog import TABLES, TableSpec
from merchlens.marts import FactoredSales, sales_mart
from merchlens.operators.keys import key_facts
from merchlens.reports import logistics, sales
from merchlens.sinks import ConstraintError, Warehouse, database_options, land_csv
from merchlens.sinks import warehouse as warehouse_module
from merchlens.sources import read_all, read_raw, read_split
from tests.fixtures import delivered, frame, raw_tables, rows

PRODUCT_HEADER = (
    "product_id,product category,product_name_length,product_description_length,"
    "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm"
)


def csv(tmp_path, text: str) -> str:
    path = tmp_path / "file.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def products(spark, tmp_path, *lines: str, strict: bool = True):
    path = csv(tmp_path, "\n".join([PRODUCT_HEADER, *lines]) + "\n")
    return read_raw(spark, path, "products", strict)


def test_quotes_gaps_and_float_integers(spark, tmp_path):
    (row,) = rows(products(spark, tmp_path, '1,"x, ""y""",45.0,NA,,12.345,1,nan,""'))
    assert row["product_category"] == 'x, "y"'
    assert row["product_name_length"] == 45
    assert row["product_description_length"] is None
    assert row["product_photos_qty"] is None
    assert row["product_weight_g"] == Decimal("12.35")
    assert row["product_height_cm"] is None
    assert row["product_width_cm"] is None


def test_a_value_is_cast_once(spark, tmp_path):
    plan = products(spark, tmp_path, "1,a,1,1,1,1,1,1,1")._jdf.queryExecution().optimizedPlan()
    weight = next(line for line in plan.toString().splitlines() if "product_weight_g" in line)
    assert len(re.findall(r"cast\(product_weight_g#\d+ as decimal", weight)) == 1


def test_whole_numbers_in_any_writing(spark, tmp_path):
    written = ("45", "45.0", " 7 ", "+5", "-3", "1e3", "45.5", "3000000000", "many", "NaN")
    lines = [f"{at},a,{text},1,1,1,1,1,1" for at, text in enumerate(written)]
    found = products(spark, tmp_path, *lines, strict=False).orderBy("product_id")
    values = [row["product_name_length"] for row in rows(found)]
    assert values == [45, 45, 7, 5, -3, 1000, None, None, None, None]


def test_types_follow_the_catalogue(spark, tmp_path):
    assert dict(products(spark, tmp_path, "1,a,1,1,1,1,1,1,1").dtypes) == {
        name: "string" if kind.startswith("varchar") else kind
        for name, kind in TABLES["products"].columns.items()
    }


@pytest.mark.parametrize(
    "line",
    [
        "1,a,many,1,1,1,1,1,1",
        "1,a,1,1,1,1,99999.99,1,1",
        f"{'1' * 33},a,1,1,1,1,1,1,1",
        f"1,{'a' * 51},1,1,1,1,1,1,1",
    ],
    ids=["text in int", "decimal overflow", "long id", "long category"],
)
def test_values_a_type_cannot_hold(spark, tmp_path, line):
    with pytest.raises(Exception, match="products.product_"):
        products(spark, tmp_path, line).collect()
    assert None in rows(products(spark, tmp_path, line, strict=False))[0].values()


def test_columns_are_found_by_name(spark, tmp_path):
    path = csv(
        tmp_path,
        "extra,seller_state,seller_city,seller_id,seller_zip_code_prefix\nx,SP,c,s1,01037\n",
    )
    assert rows(read_raw(spark, path, "sellers")) == [
        {
            "seller_id": "s1",
            "seller_zip_code_prefix": 1037,
            "seller_city": "c",
            "seller_state": "SP",
        }
    ]


def test_a_missing_column_is_named(spark, tmp_path):
    with pytest.raises(ValueError, match="seller_state"):
        read_raw(spark, csv(tmp_path, "seller_id,seller_city\ns,c\n"), "sellers")


def test_files_of_one_folder_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns,1,c,SP\n"
    )
    (tmp_path / "b.csv").write_text(
        "seller_zip_code_prefix,seller_id,seller_city,seller_state\n1,s,c,SP\n"
    )
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path), "sellers").collect()


def test_timestamps_have_no_zone(spark, tmp_path):
    header = ",".join(TABLES["orders"].columns)
    path = csv(tmp_path, f"{header}\no,c,delivered,2018-11-04 00:30:00,,,,2018-01-01\n")
    (row,) = rows(read_raw(spark, path, "orders"))
    assert row["order_purchase_timestamp"] == datetime(2018, 11, 4, 0, 30)
    assert row["order_approved_at"] is None
    assert row["order_estimated_delivery_date"] == datetime(2018, 1, 1)


def test_reviews_may_hold_line_breaks(spark, tmp_path):
    folder = tmp_path / "all"
    folder.mkdir()
    (folder / "reviews.csv").write_text('star_rating,text\n5,"two\nlines"\n1,one\n')
    found = read_all(spark, str(folder)).reviews
    assert [r["star_rating"] for r in rows(found)] == [5, 1]


@pytest.fixture
def raw(spark):
    orders = delivered([24 * 3, 24 * 20, 24])
    for n, order in enumerate(orders):
        order["order_purchase_timestamp"] = datetime(2018, 1 + n, 1, 12)
    ids = [o["order_id"] for o in orders]
    return raw_tables(
        spark,
        orders=orders,
        items=[{"order_id": i, "price": 5, "product_id": 'odd, "id"'} for i in ids + ids[:1]],
        payments=[{"order_id": i, "payment_value": 7} for i in ids + ids[:1]],
    )


def warehouse(spark, tmp_path, **options) -> Warehouse:
    tag = uuid.uuid4().hex[:8]
    return Warehouse(spark, str(tmp_path / tag), raw=f"raw_{tag}", dm=f"dm_{tag}", **options)


def with_geolocation(raw, spark):
    return raw.replace(geolocation=frame(spark, "geolocation", []))


@pytest.mark.parametrize("buckets", [None, 4])
def test_round_trip_through_files_tables_and_marts(spark, tmp_path, raw, buckets):
    raw = with_geolocation(raw, spark)
    for name in TABLES:
        land_csv(getattr(raw, name), str(tmp_path / "landing"), name)
    landed = read_all(spark, str(tmp_path / "landing"))
    house = warehouse(spark, tmp_path, buckets=buckets)
    report = {r["table_name"]: r for r in rows(house.load_all(lambda n: getattr(landed, n)))}
    assert {n: r["rows"] for n, r in report.items()} == {
        "customers": 3,
        "sellers": 1,
        "products": 2,
        "geolocation": 0,
        "orders": 3,
        "order_items": 4,
        "payments": 4,
    }
    for name in TABLES:
        assert sorted(map(str, getattr(house.tables(), name).collect())) == sorted(
            map(str, getattr(raw, name).collect())
        )
    built = {r["mart"]: r["rows"] for r in rows(house.build_marts())}
    assert built == {"sales": 6, "delivery": 4, "purchasing_power": 4}
    assert house.sales().latest == datetime(2018, 3, 1, 12)
    expected = rows(sales.kpi_trend(raw, "turnover", "last_year"))
    for source in (house.sales(), house.raw_sales(), house.tables()):
        assert rows(sales.kpi_trend(source, "turnover", "last_year")) == expected
    for source in (house.delivery(), house.raw_delivery()):
        assert rows(logistics.delivery_histogram(source)) == rows(logistics.delivery_histogram(raw))
    view = spark.table(f"{house.dm}.sales")
    assert view.columns == [*sales_mart(raw).columns, "purchase_month"]


def test_delivery_rows_of_an_order_are_stored_together(spark, tmp_path):
    ids = [f"o{n:03}" for n in range(60)]
    items = [{"order_id": o, "price": 1} for _ in range(3) for o in ids]
    model = raw_tables(
        spark,
        delivered([24.0] * len(ids)),
        items,
        [{"order_id": o, "payment_value": 1} for o in ids],
    ).replace(geolocation=frame(spark, "geolocation", []))
    house = warehouse(spark, tmp_path)
    house.load_all(lambda name: getattr(model, name))
    house.build_marts()
    stored = house.delivery().mart
    assert stored.count() == 180
    for file in stored.inputFiles():
        held = [row["order_id"] for row in rows(spark.read.parquet(file))]
        assert held == sorted(held)


def test_mart_rebuild_replaces_rows_and_keeps_few_versions(spark, tmp_path, raw):
    house = warehouse(spark, tmp_path)
    house.load_all(lambda n: getattr(with_geolocation(raw, spark), n))
    for _ in range(4):
        house.build_marts()
    assert spark.table(f"{house.dm}.sales").count() == 6
    versions = spark.sql(f"SHOW TABLES IN {house.dm} LIKE 'sales__*'").count()
    assert versions == house.keep_versions


def loaded(spark, tmp_path, raw) -> Warehouse:
    house = warehouse(spark, tmp_path)
    house.load_all(lambda n: getattr(with_geolocation(raw, spark), n))
    return house


def test_loading_a_parent_empties_its_dependants(spark, tmp_path, raw):
    house = loaded(spark, tmp_path, raw)
    assert house.load_table("orders", raw.orders).rows == 3
    counts = {n: spark.table(f"{house.raw}.{n}").count() for n in TABLES}
    assert (counts["customers"], counts["orders"]) == (3, 3)
    assert (counts["order_items"], counts["payments"]) == (0, 0)


def test_truncate_cascades(spark, tmp_path, raw):
    house = loaded(spark, tmp_path, raw)
    assert house.truncate("sellers") == ["sellers", "order_items"]
    assert spark.table(f"{house.raw}.order_items").count() == 0
    assert spark.table(f"{house.raw}.payments").count() == 4


@pytest.mark.parametrize("table", ["orders", "payments", "order_items"])
def test_a_load_that_breaks_a_rule_changes_nothing(spark, tmp_path, raw, table):
    """A repeated key, a key without a value, and a reference to no row."""
    house = loaded(spark, tmp_path, raw)
    good = getattr(raw, table)
    bad = {
        "orders": good.union(good.limit(1)),
        "payments": good.withColumn("order_id", F.lit(None).cast("string")),
        "order_items": good.withColumn("seller_id", F.lit("gone")),
    }[table]
    before = spark.table(f"{house.raw}.{table}").count()
    with pytest.raises(ConstraintError, match=table):
        house.load_table(table, bad)
    assert spark.table(f"{house.raw}.{table}").count() == before
    assert spark.table(f"{house.raw}.order_items").count() == 4
    report = house.load_table(table, bad, enforce=False)
    assert report.problems()


@pytest.mark.parametrize("column, value", [("price", "99999.99"), ("product_id", "repeat('y', 40)")])
def test_table_types_reject_what_does_not_fit(spark, tmp_path, raw, column, value):
    house = loaded(spark, tmp_path, raw)
    items = raw.order_items.withColumn(column, F.expr(value))
    with pytest.raises(Exception, match="(?i)overflow|EXCEED_LIMIT_LENGTH|NUMERIC_VALUE_OUT_OF"):
        house.load_table("order_items", items)
    assert spark.table(f"{house.raw}.order_items").count() == 4


def test_refused_loads_leave_no_version_and_displace_none(spark, tmp_path, raw):
    house = loaded(spark, tmp_path, raw)
    held = house.tables().customers

    def versions():
        return {
            name: spark.sql(f"SHOW TABLES IN {house.raw} LIKE '{name}__*'").count()
            for name in TABLES
        }

    before = versions()
    broken = with_geolocation(raw, spark).replace(
        order_items=raw.order_items.withColumn("seller_id", F.lit("gone"))
    )
    for _ in range(3):
        with pytest.raises(ConstraintError, match="order_items"):
            house.load_all(lambda n: getattr(broken, n))
    with pytest.raises(ConstraintError):
        house.load_table("orders", raw.orders.union(raw.orders))
    assert versions() == before
    house.load_all(lambda n: getattr(with_geolocation(raw, spark), n))
    assert held.count() == 3


def repeated_and_orphaned(raw):
    """Repeated orders, customers and sellers, and items of no known seller."""
    return raw.replace(
        orders=raw.orders.union(raw.orders.limit(1)),
        customers=raw.customers.union(raw.customers.limit(2)),
        sellers=raw.sellers.union(raw.sellers.limit(1)),
        order_items=raw.order_items.withColumn(
            "seller_id", F.when(F.col("order_item_id") == 1, F.col("seller_id")).otherwise("gone")
        ),
    )


def test_raw_figures_are_the_marts_whatever_was_loaded(spark, tmp_path, raw):
    house = warehouse(spark, tmp_path)
    broken = with_geolocation(repeated_and_orphaned(raw), spark)
    report = house.load_all(lambda n: getattr(broken, n), enforce=False)
    assert {r.table_name for r in report.where("orphan_keys > 0").collect()} == {"order_items"}
    house.build_marts()
    assert not house.raw_sales().keys_enforced and not house.raw_delivery().keys_enforced
    reports = (
        sales.sales_monthly,
        sales.payment_methods,
        lambda s: sales.kpi_by_state(s, "orders", "last_year"),
        lambda s: sales.kpi(s, "aov", "last_year"),
    )
    for report in reports:
        assert rows(report(house.raw_sales())) == rows(report(house.sales()))
        assert rows(report(broken)) == rows(report(house.sales()))
    for report in (logistics.delivery_histogram, logistics.fastest_cities):
        assert rows(report(house.raw_delivery())) == rows(report(house.delivery()))
    house.load_all(lambda n: getattr(with_geolocation(raw, spark), n))
    assert house.raw_sales().keys_enforced


def test_edge_blanks_land_and_line_breaks_do_not(spark, tmp_path, raw):
    cities = raw.customers.withColumn("customer_city", F.lit("  lead city "))
    path = land_csv(cities, str(tmp_path), "customers")
    assert {r.customer_city for r in read_raw(spark, path, "customers").collect()} == {
        "  lead city "
    }
    broken = raw.customers.withColumn("customer_city", F.lit("two\nlines"))
    with pytest.raises(Exception, match="customers.customer_city: a line break in"):
        land_csv(broken, str(tmp_path / "bad"), "customers")


def test_dropping_a_warehouse_leaves_nothing(spark, tmp_path, raw):
    house = loaded(spark, tmp_path, raw)
    house.build_marts()
    house.drop()
    names = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    assert not {house.raw, house.dm} & names


def test_all_tables_change_at_one_instant(spark, tmp_path, raw):
    """A reader that asks for several tables while loads go on never sees two loads."""
    house = loaded(spark, tmp_path, raw)
    views = [f"{house.raw}.{name}" for name in ("customers", "sellers", "orders")]
    question = "select " + ", ".join(
        f"(select max({column}) from {view}) as of{at}"
        for at, (view, column) in enumerate(
            zip(views, ("customer_city", "seller_city", "order_status"))
        )
    )
    seen, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.sql(question).first()))
                # Frames taken together are of one load, however late they are read.
                held = house.tables()
                frames = (held.customers.select("customer_city"), held.orders.select("order_status"))
                seen.append(tuple({f.first()[0] for f in frames} | {frames[0].first()[0]}) * 3)
            except Exception as problem:  # noqa: BLE001
                failed.append(str(problem)[:300])

    def tagged(tag):
        return with_geolocation(raw, spark).replace(
            customers=raw.customers.withColumn("customer_city", F.lit(tag)),
            sellers=raw.sellers.withColumn("seller_city", F.lit(tag)),
            orders=raw.orders.withColumn("order_status", F.lit(tag)),
        )

    house.keep_versions = 6
    first = tagged("load 0")
    house.load_all(lambda n: getattr(first, n))
    readers = [threading.Thread(target=read) for _ in range(3)]
    for reader in readers:
        reader.start()
    for load in range(1, 5):
        frames = tagged(f"load {load}")
        house.load_all(lambda n: getattr(frames, n))
    stop.set()
    for reader in readers:
        reader.join()
    assert failed == []
    assert all(len(set(found)) == 1 for found in seen) and len(set(seen)) > 2


def test_views_leave_one_version_in_the_plan(spark, tmp_path, raw):
    house = loaded(spark, tmp_path, raw)
    house.load_all(lambda n: getattr(with_geolocation(raw, spark), n))
    plan = spark.table(f"{house.raw}.orders")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan and "subquery" not in plan


def test_children_stay_when_their_parent_is_loaded_anew(spark, tmp_path, raw):
    house = loaded(spark, tmp_path, raw)
    items = house.tables().order_items.inputFiles()
    report = house.load_table("orders", raw.orders.withColumn("order_status", F.lit("new")), reload=True)
    assert {c.table: c.rows for c in report.children} == {"order_items": 4, "payments": 4}
    assert house.tables().order_items.inputFiles() == items
    assert spark.table(f"{house.raw}.payments").count() == 4
    assert {r.order_status for r in spark.table(f"{house.raw}.orders").collect()} == {"new"}
    assert house.raw_sales().keys_enforced and house.raw_sales().latest == datetime(2018, 3, 1, 12)


def test_children_without_parents_refuse_the_load(spark, tmp_path, raw):
    house = loaded(spark, tmp_path, raw)
    fewer = raw.orders.where(F.col("order_id") != "o002")
    with pytest.raises(ConstraintError, match="payments"):
        house.load_table("orders", fewer, reload=True)
    assert spark.table(f"{house.raw}.orders").count() == 3
    report = house.load_table("orders", fewer, enforce=False, reload=True)
    assert {c.table: c.orphan_keys for c in report.children} == {"order_items": 1, "payments": 1}
    assert not house.raw_sales().keys_enforced
    assert house.raw_sales().latest == datetime(2018, 2, 1, 12)


def test_children_come_from_a_source_when_one_is_given(spark, tmp_path, raw):
    house = loaded(spark, tmp_path, raw)
    left = F.col("order_id") != "o002"
    given = {"payments": raw.payments.where(left), "order_items": raw.order_items.where(left)}
    report = house.load_table("orders", raw.orders.where(left), reload=given.get)
    assert not report.problems() and not any(c.problems() for c in report.children)
    assert spark.table(f"{house.raw}.payments").count() == 3
    house.load_table("customers", raw.customers, reload=lambda name: None)
    assert spark.table(f"{house.raw}.order_items").count() == 3


def test_bad_lines_are_set_apart_with_their_reasons(spark, tmp_path, raw):
    header = ",".join(TABLES["payments"].columns)
    lines = [
        "o000,1,card,1,5.00",
        "o000,2,card,one,5.00",
        "o001,1,card,2,123456.00",
        "o001,2,a very long type of payment,x,7",
        "o002,1,card",
        "o002,2,card,1,5.00,more",
        "o002,3,,NA,",
    ]
    path = csv(tmp_path, "\n".join([header, *lines]) + "\n")
    house = warehouse(spark, tmp_path)
    frames = with_geolocation(raw, spark).replace(payments=read_split(spark, path, "payments"))
    house.load_all(lambda n: getattr(frames, n), enforce=False)
    counts = {r.table_name: (r.rows, r.rejected_rows) for r in house.row_counts().collect()}
    assert counts["payments"] == (2, 5) and counts["orders"] == (3, 0)
    assert sorted(map(tuple, house.rejections().collect()), key=str) == sorted(
        [
            ("payments", "payment_installments", "one", "not of type int"),
            ("payments", "payment_value", "123456.00", "not of type decimal(7,2)"),
            ("payments", "payment_type", "a very long type of payment", "not of type varchar(15)"),
            ("payments", "payment_installments", "x", "not of type int"),
            ("payments", None, "o002,1,card", "another number of fields"),
            ("payments", None, "o002,2,card,1,5.00,more", "another number of fields"),
        ],
        key=str,
    )
    for frame_ in (house.tables().payments, spark.table(f"{house.raw}.payments")):
        assert frame_.columns == list(TABLES["payments"].columns)
        assert sorted(r.payment_sequential for r in frame_.collect()) == [1, 3]
    house.load_all(lambda n: getattr(with_geolocation(raw, spark), n))
    assert house.rejections().count() == 0


def test_keys_and_references_take_one_scan(spark, tmp_path, raw):
    house = loaded(spark, tmp_path, raw)
    held = house.tables()
    parents = {name: getattr(held, name) for name in ("orders", "products", "sellers")}
    facts = key_facts(held.order_items, TABLES["order_items"], parents)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    version = held.order_items._jdf.queryExecution().analyzed().toString()
    assert plan.count("order_item_id#") >= 1 and plan.count("Relation") == 4 and "order_items__" in version
    assert plan.count("order_items__") == 1


def test_keys_of_several_parts_are_not_confused(spark):
    """('1', '11') and ('11', '1'), parts with separators, and a NULL part."""
    spec = TableSpec("t", {"a": "string", "b": "string"}, ("a", "b"))
    pairs = [("1", "11"), ("11", "1"), ("1:", "1"), ("1", ":1"), (None, "1"), ("1", "11")]
    found = key_facts(spark.createDataFrame(pairs, "a string, b string"), spec, {}).first()
    assert (found.keyed_rows, found.unique_keys, found.duplicate_rows, found.null_keys) == (6, 4, 1, 1)


def test_a_landing_that_fails_leaves_the_copy_before(spark, tmp_path, raw):
    folder = str(tmp_path / "landing")
    path = land_csv(raw.sellers, folder, "sellers")
    broken = raw.sellers.withColumn("seller_city", F.raise_error(F.lit("no more")).cast("string"))
    with pytest.raises(Exception, match="no more"):
        land_csv(broken, folder, "sellers")
    assert read_raw(spark, path, "sellers").count() == 1
    reading = read_raw(spark, path, "sellers")
    land_csv(raw.sellers.withColumn("seller_city", F.lit("moved")), folder, "sellers")
    assert [r.seller_city for r in read_raw(spark, path, "sellers").collect()] == ["moved"]
    # A reader that had begun still finds its copy; the unfinished one is gone.
    assert [r.seller_city for r in reading.collect()] == ["city-s"]
    copies = [p.name for p in Path(path).iterdir() if p.name.startswith("copy-")]
    assert len(copies) == 2
    land_csv(raw.sellers, folder, "sellers")
    assert len([p for p in Path(path).iterdir() if p.name.startswith("copy-")]) == 2


def test_database_refresh_truncates_with_cascade_in_batches():
    options = database_options("jdbc:postgresql://host/db", "raw.orders", user="u")
    assert options["truncate"] == options["cascadeTruncate"] == "true"
    assert options["batchsize"] == "10000"
    assert options["user"] == "u"



def test_keys_and_references_are_counted_without_a_join(spark):
    """Parents that repeat or are NULL, repeated and NULL keys, NULL and unknown references."""
    spec = TableSpec("t", {"a": "string", "b": "string"}, ("a",), {"b": "parents"})
    pairs = [("1", "x"), ("1", "y"), (None, "y"), ("2", None), ("3", "z"), ("4", "z"), ("x", "q")]
    parents = {"parents": spark.createDataFrame([("x",), ("x",), (None,)], "b string")}
    found = key_facts(spark.createDataFrame(pairs, "a string, b string"), spec, parents)
    facts = found.first()
    assert (facts.keyed_rows, facts.unique_keys, facts.duplicate_rows, facts.null_keys) == (7, 5, 1, 1)
    assert facts.orphans == [3]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan


@pytest.mark.parametrize("sold", [2, 1, 0])
def test_the_last_purchase_is_looked_for_among_the_newest_orders(
    spark, tmp_path, raw, monkeypatch, sold
):
    """With one newest order at a time: it is sold, only an older one is, or none is."""
    monkeypatch.setattr(warehouse_module, "NEWEST_ORDERS", 1)
    looked = []
    counted = FactoredSales.sold_orders
    monkeypatch.setattr(
        FactoredSales, "sold_orders", lambda self: looked.append(self) or counted(self)
    )
    ids = [r.order_id for r in raw.orders.orderBy("order_purchase_timestamp").collect()]
    some = raw.replace(payments=raw.payments.where(F.col("order_id").isin(ids[: sold + 1 if sold else 0])))
    house = loaded(spark, tmp_path, some)
    latest = house.raw_sales().latest
    if not sold:
        assert latest is None and not looked
    else:
        assert latest == datetime(2018, 1 + sold, 1, 12)
        assert len(looked) == (1 if sold == 2 else 2)


def test_kept_rows_are_checked_against_new_parents_only(spark, tmp_path, raw, monkeypatch):
    house = loaded(spark, tmp_path, raw)
    checked = {}

    def facts(rows, spec, parents):
        checked[spec.name] = (spec.primary_key, tuple(spec.references))
        return key_facts(rows, spec, parents)

    monkeypatch.setattr(warehouse_module, "key_facts", facts)
    house.load_table("orders", raw.orders, reload=True)
    assert checked == {
        "orders": (("order_id",), ("customer_id",)),
        "order_items": ((), ("order_id",)),
        "payments": ((), ("order_id",)),
    }
    # Rows that were loaded with a broken key are checked whole.
    twice = raw.payments.union(raw.payments.limit(1))
    house.load_table("payments", twice, enforce=False)
    report = house.load_table("orders", raw.orders, enforce=False, reload=True)
    assert checked["payments"] == (TABLES["payments"].primary_key, ("order_id",))
    assert {c.table: c.duplicate_rows for c in report.children} == {"order_items": 0, "payments": 1}


def test_compressed_landing_copies_read_back_the_same(spark, tmp_path):
    sellers = spark.range(20000).selectExpr(
        "cast(id as string) as seller_id",
        "cast(id % 100 as int) as seller_zip_code_prefix",
        "concat('  \"', id % 7, '\", city ') as seller_city",
        "if(id % 5 = 0, null, 'SP') as seller_state",
    )
    sizes = {}
    for kind in ("none", "lz4"):
        path = land_csv(sellers, str(tmp_path / kind), "sellers", compression=kind)
        back = read_raw(spark, path, "sellers").select(sellers.columns)
        assert back.exceptAll(sellers).count() == 0 and back.count() == 20000
        assert read_split(spark, path, "sellers").where("size(_problems) > 0").count() == 0
        sizes[kind] = sum(file.stat().st_size for file in Path(path).rglob("part-*"))
    assert sizes["lz4"] < sizes["none"] / 2
