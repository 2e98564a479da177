"""What the plans of the reports must and must not hold, and that skew is split."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from merchlens.marts import FactoredSales, delivery_mart, sales_mart
from merchlens.operators import checks
from merchlens.registry import queries
from merchlens.reports import abc, logistics, sales
from merchlens.sinks import Warehouse
from merchlens.sources import sample_specs, with_deliveries
from tests.comparison import SAMPLE
from tests.fixtures import raw_tables, rows

FOLDER = f"{SAMPLE}/sf0.001"


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before: dict[str, str | None] = {}

    def change(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def model(spark):
    return with_deliveries(spark, FOLDER)


NEVER_LOCAL = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "Expand")


@pytest.mark.parametrize(
    "name",
    [
        "mart_sales",
        "mart_delivery",
        "sales_monthly",
        "kpi_aov_last_year",
        "kpi_trend_aov_last_year",
        "top_categories_customers_last_quarter",
        "abc_state",
        "late_share",
        "delivery_histogram",
        "problem_routes",
        "dq_fk",
        "entity_counts",
    ],
)
def test_no_pairing_expanding_or_python(spark, name):
    plan = physical(queries()[name](spark, FOLDER))
    for operator in NEVER_LOCAL:
        assert operator not in plan


def test_no_registered_report_expands_rows(spark):
    """Loads aside, which run when they are called."""
    for name, query in queries().items():
        if not name.startswith(("load_", "truncate_")):
            assert "Expand" not in physical(query(spark, FOLDER)), name


def test_methods_of_clean_tables_expand_nothing(model):
    clean = physical(sales.payment_methods(FactoredSales(model, keys_enforced=True)))
    assert "Expand" not in clean


def test_mart_of_tables_by_order_shuffles_nothing_by_order(house, settings):
    """Products, sellers and customers are too large to broadcast here."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    mart = sales_mart(house.tables(), by_order=True)
    shuffles = [line for line in physical(mart).splitlines() if "Exchange" in line]
    assert shuffles and not any("hashpartitioning(order_id" in line for line in shuffles)
    assert any("hashpartitioning(product_id" in line for line in shuffles)
    mart_rows = sorted(map(str, mart.select("order_id", "price", "payment_value").collect()))
    other = sales_mart(house.tables()).select("order_id", "price", "payment_value")
    assert mart_rows == sorted(map(str, other.collect()))


def test_trailing_reports_on_loaded_tables_look_for_no_last_purchase(house):
    for report in (sales.kpi, sales.kpi_trend, sales.top_categories):
        plan = physical(report(house.raw_sales(), "turnover", "last_month"))
        assert "Subquery" not in plan and "max(order_purchase_timestamp" not in plan
        assert "2001-07-01" in plan


def test_references_of_a_child_take_one_scan_of_it(model):
    plan = optimized(checks.fk_checks(model))
    # Two children with one reference each, and items with three: one scan each.
    assert plan.count("Generate explode") == 3 and plan.count("l_suppkey") == 2


def test_other_orders_are_dropped_before_anything_is_added_up(model):
    """In a trailing report, items and payments meet the period's orders first."""
    plan = optimized(sales.kpi(model, "turnover", "last_month")).splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    sums = [i for i, line in enumerate(plan) if "Aggregate [order_id" in line]
    assert len(sums) >= 2
    for at in sums:
        below = []
        for line in plan[at + 1 :]:
            if depth(line) <= depth(plan[at]):
                break
            below.append(line)
        assert any("Join LeftSemi" in line for line in below)


def test_top_reports_keep_only_the_top(model):
    for frame in (
        sales.top_categories(model, "turnover", "last_year"),
        logistics.fastest_cities(model),
    ):
        assert "TakeOrderedAndProject" in physical(frame)


def test_only_needed_columns_are_read(spark):
    plan = physical(queries()["kpi_turnover_last_year"](spark, FOLDER))
    assert "l_tax" not in plan and "l_extendedprice" not in plan and "p_name" not in plan


def test_reports_sum_without_pairing_items_and_payments(model):
    """Both sides of the last join hold one row per order."""
    plan = optimized(FactoredSales(model).rows())
    assert plan.count("Aggregate [order_id") == 2


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored"))
    built = Warehouse(spark, folder, sample_specs(), raw="raw_plans", dm="dm_plans", buckets=8)
    tables = with_deliveries(spark, FOLDER)
    built.load_all(lambda name: getattr(tables, name), enforce=False)
    built.build_marts()
    return built


def test_stored_by_order_needs_no_shuffle_by_order(house, settings):
    settings(autoBroadcastJoinThreshold="-1")
    plan = physical(FactoredSales(house.tables(), keys_enforced=True).rows())
    assert plan.count("SortMergeJoin") == 2
    assert "Exchange" not in plan


def test_each_bucket_is_one_file(house):
    for name in ("orders", "order_items", "payments"):
        assert len(getattr(house.tables(), name).inputFiles()) == 8


def test_trailing_period_reads_its_own_months(house):
    frame = sales.kpi(house.sales(), "turnover", "last_month")
    scan = next(line for line in physical(frame).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(purchase_month" in scan
    assert "purchase_month" in scan and ">= 2001-07-01" in scan
    assert "Subquery" not in physical(frame)


def test_sql_and_frames_of_the_view_read_their_own_months(spark, house):
    view = f"{house.dm}.sales"
    by_sql = spark.sql(f"select sum(price) from {view} where purchase_month >= '2001-07-01'")
    by_report = sales.kpi(spark.table(view), "turnover", "last_month")
    for frame in (by_sql, by_report):
        scans = [line for line in physical(frame).splitlines() if "FileScan" in line]
        assert any("PartitionFilters: [isnotnull(purchase_month" in line for line in scans)


def test_stored_and_raw_reports_agree(house, model):
    for metric in ("turnover", "customers"):
        expected = rows(sales.kpi_by_state(model, metric, "last_quarter"))
        for source in (house.sales(), house.raw_sales()):
            assert rows(sales.kpi_by_state(source, metric, "last_quarter")) == expected
    assert rows(abc.abc_detail(house.sales(), "customer_state")) == rows(
        abc.abc_detail(model, "customer_state")
    )


HOT = "third"


def hot_model(model, spark):
    """The sample with a third of all items, or of all payments, in one order."""
    hot = F.rand(7) < 0.33
    first = model.orders.select("order_id").first()[0]

    def heated(frame, key, value):
        return frame.withColumn(key, F.when(hot, value).otherwise(F.col(key)))

    return {
        "items of one order": model.replace(
            order_items=heated(model.order_items, "order_id", first)
        ),
        "payments of one order": model.replace(
            payments=heated(
                model.payments.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(8)))).drop("n"),
                "order_id",
                first,
            ),
            order_items=model.order_items.where(F.col("order_id") != first).union(
                model.order_items.where(F.col("order_id") == first).limit(1)
            ),
        ),
        "orders of one customer": model.replace(orders=heated(model.orders, "customer_id", "0")),
        "items of one product": model.replace(
            order_items=heated(model.order_items, "product_id", "0")
        ),
        "items of one seller": model.replace(
            order_items=heated(model.order_items, "seller_id", "0")
        ),
    }


def small_sizes(settings):
    """Sizes scaled down to the sample, so that its hot keys stand out."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        shuffle__partitions="16",
        files__maxPartitionBytes="16KB",
        files__openCostInBytes="0",
        adaptive__advisoryPartitionSizeInBytes="4KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__coalescePartitions__enabled="false",
    )


def spread(hot):
    return hot.replace(
        order_items=hot.order_items.repartition(12),
        payments=hot.payments.repartition(12),
        orders=hot.orders.repartition(12),
    )


@pytest.mark.parametrize(
    "kind",
    [
        "items of one order",
        "payments of one order",
        "orders of one customer",
        "items of one product",
        "items of one seller",
    ],
)
def test_mart_joins_split_hot_keys(spark, model, settings, kind):
    small_sizes(settings)
    mart = sales_mart(spread(hot_model(model, spark)[kind]))
    mart.collect()
    assert "skew=true" in physical(mart)


@pytest.mark.parametrize(
    "kind", ["items of one order", "orders of one customer", "items of one seller"]
)
def test_delivery_mart_splits_hot_keys(spark, model, settings, kind):
    small_sizes(settings)
    mart = delivery_mart(spread(hot_model(model, spark)[kind]))
    mart.collect()
    assert "skew=true" in physical(mart)


@pytest.mark.parametrize("kind", ["items of one product", "items of one seller"])
def test_raw_reports_split_hot_parents(spark, model, settings, kind):
    small_sizes(settings)
    report = sales.top_categories(spread(hot_model(model, spark)[kind]), "turnover", "last_year")
    report.collect()
    assert "skew=true" in physical(report)


@pytest.mark.parametrize("metric", ["orders", "arpu"])
def test_top_reports_hash_small_partitions_and_sort_large_ones(spark, settings, metric):
    """A task keeps one side of a join, not both of them sorted, unless that side is large."""
    orders = [{"order_id": f"o{n}"} for n in range(40)]
    model = raw_tables(
        spark,
        orders,
        [{"order_id": o["order_id"], "price": 2, "product_id": f"p{o['order_id']}"} for o in orders],
        [{"order_id": o["order_id"], "payment_value": 3} for o in orders],
    )
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    found = []
    for threshold in (None, "1B"):
        if threshold:
            settings(
                adaptive__advisoryPartitionSizeInBytes="1B",
                adaptive__maxShuffledHashJoinLocalMapThreshold=threshold,
            )
        report = sales.top_categories(model, metric, "last_year")
        found.append(rows(report))
        report.collect()
        final = physical(report).split("Initial Plan")[0]
        assert ("ShuffledHashJoin" in final) == (threshold is None)
        assert ("SortMergeJoin" in final) == (threshold is not None)
    assert found[0] == found[1] and found[0]


def test_hot_orders_are_collapsed_before_they_are_shuffled(spark, model):
    """Figures from raw tables pair nothing, so a hot order is a handful of rows."""
    hot = hot_model(model, spark)["items of one order"]
    first = model.orders.select("order_id").first()[0]
    source = FactoredSales(hot)
    found = source.rows("product_category", "payment_type").where(F.col("order_id") == first)
    categories = hot.products.select("product_category").distinct().count()
    assert hot.order_items.where(F.col("order_id") == first).count() > 1000
    assert found.count() <= categories * 4
    assert rows(sales.payment_methods(hot)) == rows(sales.payment_methods(sales_mart(hot)))


def test_sales_come_by_order(model, settings):
    """Even where its sides are small enough to hash, the join that makes pairs merges."""
    settings(autoBroadcastJoinThreshold="-1")
    frame = sales_mart(model)
    frame.collect()
    final = physical(frame).split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin [order_id" in final and "SortMergeJoin [order_id" in final


def test_orders_are_shuffled_as_read(model):
    """Texts and times are made of the numbers and the date of an order after its join."""
    plan = physical(model.orders)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(order_id" not in plan


def test_shuffle_files_go_with_their_query(spark):
    """While the frame is still there: driver memory decides when its garbage is collected."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        names = (str(file.getName()) for file in _listed(disk.getAllFiles()))
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffled()
    frame = spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count()
    assert len(frame.collect()) == 97
    late = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < late:
        time.sleep(0.2)
    assert not shuffled() - before
    assert len(frame.collect()) == 97


def _listed(files) -> list:
    return [files.apply(at) for at in range(files.size())]
