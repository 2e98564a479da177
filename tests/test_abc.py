from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchlens.marts import sales_mart
from merchlens.operators.running_total import running_total
from merchlens.reports import abc
from tests.fixtures import categories_with_revenue, raw_tables, rows


def shares(frame, key="product_category"):
    return {r[key]: r["cumulative_pct"] for r in rows(frame)}


def test_equal_revenues_share_their_cumulative_percent(spark):
    raw = categories_with_revenue(spark, {"a": 5, "b": 5, "c": 1})
    found = shares(abc.pareto(raw, "product_category"))
    assert found == {"a": Decimal("90.909"), "b": Decimal("90.909"), "c": Decimal("100.000")}
    classes = rows(abc.abc_revenue(raw, "product_category"))
    assert {r["abc_group"]: r["revenue"] for r in classes} == {
        "B": Decimal("10.00"),
        "C": Decimal("1.00"),
    }


def test_classes_use_the_rounded_percent(spark):
    """8000.04 of 10000.00 is 80.0004 percent, which rounds into class A."""
    raw = categories_with_revenue(spark, {"a": "8000.04", "b": "1999.96"})
    found = rows(abc.abc_detail(raw, "product_category"))
    assert [(r["abc_group"], r["product_category"]) for r in found] == [("A", "a"), ("C", "b")]


def test_a_dominant_first_item_leaves_class_a_empty(spark):
    raw = categories_with_revenue(spark, {"a": 90, "b": 10})
    found = rows(abc.abc_classes(raw, "product_category"))
    assert {r["abc_group"] for r in found} == {"B", "C"}


def test_summary_is_ordered_by_the_text_of_revenue(spark):
    """Class B sells 10.00 and class C 9.00; as text, 10.00 comes first."""
    raw = categories_with_revenue(spark, {"a": 79, "b": 12, "c": 9})
    found = rows(abc.abc_classes(raw, "product_category"))
    assert [r["abc_group"] for r in found] == ["B", "A", "C"]
    assert [r["revenue"] for r in found] == ["12.00 (12.00%)", "79.00 (79.00%)", "9.00 (9.00%)"]
    assert [r["members"] for r in found] == ["1 (33.33%)"] * 3
    by_class = rows(abc.abc_classes(raw, "product_category", by_label=False))
    assert [r["abc_group"] for r in by_class] == ["A", "B", "C"]


def test_order_values_are_averaged_over_members(spark):
    raw = raw_tables(
        spark,
        orders=[{"order_id": o} for o in "abc"],
        items=[
            {"order_id": "a", "product_id": "x", "price": 10},
            {"order_id": "b", "product_id": "x", "price": 20},
            {"order_id": "c", "product_id": "y", "price": 30},
        ],
        payments=[{"order_id": o, "payment_value": 1} for o in "abc"],
    )
    (found,) = rows(abc.abc_classes(raw, "product_category"))
    assert (found["abc_group"], found["aov"], found["orders"]) == ("C", Decimal("22.5"), 3)


def test_missing_category_and_missing_revenue(spark):
    raw = categories_with_revenue(spark, {None: 70, "b": 20, "c": 10, "d": 1})
    raw = raw.replace(
        order_items=raw.order_items.withColumn(
            "price", F.when(F.col("product_id") != "p3", F.col("price"))
        )
    )
    found = {r["product_category"]: r for r in rows(abc.pareto(raw, "product_category"))}
    assert found[None]["cumulative_pct"] == Decimal("70.000")
    assert found["d"]["cumulative_pct"] is None
    assert found["d"]["total_revenue"] == Decimal("100.00")
    classes = {r["abc_group"]: r for r in rows(abc.abc_classes(raw, "product_category"))}
    assert classes["A"]["members"] == "0 (0.00%)"
    assert classes["C"]["members"] == "2 (66.67%)"


def test_canceled_orders_have_no_revenue(spark):
    raw = categories_with_revenue(spark, {"a": 5, "b": 5})
    raw = raw.replace(
        orders=raw.orders.withColumn(
            "order_status", F.when(F.col("order_id") == "o0", "canceled").otherwise("delivered")
        )
    )
    assert shares(abc.pareto(raw, "product_category")) == {"b": Decimal("100.000")}
    assert shares(abc.pareto(sales_mart(raw), "product_category")) == {"b": Decimal("100.000")}


def brute_running(values):
    return {
        (k, v): None if v is None else sum(o for o in values if o is not None and o >= v)
        for k, v in enumerate(values)
    }


@pytest.mark.parametrize("seed", range(3))
def test_running_total_by_levels_equals_brute_force(spark, seed):
    """Values of very different size, many ties, negative ones and NULLs."""
    pick = random.Random(seed)
    cents = [0, 1, -1, 7, 2**20, 2**20 + 1, -(2**20), 2**40, 2**40 - 1, 2**41 + 5, None]
    values = [pick.choice(cents) for _ in range(60)] + [
        pick.randrange(-(2**30), 2**44) for _ in range(60)
    ]
    values = [None if c is None else Decimal(c) / 100 for c in values]
    frame = spark.createDataFrame(list(enumerate(values)), "k int, v decimal(20,2)")
    expected = brute_running(values)
    found = {(r.k, r.v): r.running for r in running_total(frame, "v").collect()}
    assert found == expected


@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(18,6)"])
def test_running_total_of_any_number(spark, kind):
    pick = random.Random(9)
    values = [float(pick.choice([0, -3, 5, 0.25, 1e-5, 12345.5])) * pick.randrange(1, 9) for _ in range(90)]
    frame = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    frame = frame.withColumn("v", F.col("v").cast(kind))
    given = {r.k: r.v for r in frame.collect()}
    for r in running_total(frame, "v").collect():
        expected = sum(v for v in given.values() if v >= given[r.k])
        assert float(r.running) == pytest.approx(float(expected), abs=1e-6)


def counted_model(spark, reads):
    """A model whose items add to `reads` whenever one is read."""

    def read(row):
        reads.add(1)
        return row

    raw = categories_with_revenue(spark, {"a": 5, "b": 3, "c": 1})
    items = spark.createDataFrame(raw.order_items.rdd.map(read), raw.order_items.schema)
    return raw.replace(order_items=items)


REPORTS = {
    "pareto": lambda s: abc.pareto(s, "product_category"),
    "classes": lambda s: abc.abc_classes(s, "product_category"),
    "revenue": lambda s: abc.abc_revenue(s, "product_category"),
    "detail": lambda s: abc.abc_detail(s, "product_category"),
}


@pytest.mark.parametrize("name", REPORTS)
def test_building_runs_nothing_and_running_reads_items_once(spark, name):
    context, reads = spark.sparkContext, spark.sparkContext.accumulator(0)
    raw = counted_model(spark, reads)
    context.setJobGroup(f"building {name}", "")
    report = REPORTS[name](raw)
    context.setJobGroup(f"running {name}", "")
    assert context.statusTracker().getJobIdsForGroup(f"building {name}") == []
    report.collect()
    assert reads.value == 3
    context.setLocalProperty("spark.jobGroup.id", None)


def test_small_prices_keep_all_their_decimals(spark):
    """Ten prices of 0.0049, as decimals of scale 4 and as doubles."""
    raw = categories_with_revenue(spark, {f"c{i}": i for i in range(10)})
    for kind in ("decimal(10,4)", "double"):
        priced = raw.replace(order_items=raw.order_items.withColumn("price", F.lit(0.0049).cast(kind)))
        for source in (priced, sales_mart(priced)):
            found = rows(abc.pareto(source, "product_category"))
            assert sum(float(r["pct_total"]) for r in found) == pytest.approx(100, abs=1e-6)
            assert {float(r["cumulative_pct"]) for r in found} == {100.0}
            assert {round(float(r["aov"]), 6) for r in found} == {0.0049}


def test_classes_by_amount(spark):
    raw = categories_with_revenue(spark, {"a": 79, "b": 12, "c": 9})
    found = rows(abc.abc_classes(raw, "product_category", with_amount=True))
    assert [(r["abc_group"], r["revenue_amount"]) for r in found] == [
        ("A", Decimal("79.00")),
        ("B", Decimal("12.00")),
        ("C", Decimal("9.00")),
    ]


@pytest.fixture
def many_ranges(spark):
    """As many ranges as shuffle partitions, however few the rows."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("seed", range(4))
def test_ties_are_cut_into_ranges_and_stay_peers(spark, many_ranges, seed):
    """Half of all rows share one value, others a few, and some have none."""
    pick = random.Random(seed)
    common = pick.choice([0, 5, 100])
    values = [pick.choice([common] * 6 + [1, 2, 2, 7, 100, -3, None]) for _ in range(400)]
    values = [None if v is None else Decimal(v) for v in values]
    frame = spark.createDataFrame(list(enumerate(values)), "k int, v decimal(20,2)")
    found = running_total(frame, "v").collect()
    assert {(r.k, r.v): r.running for r in found} == brute_running(values)
    assert {r.overall for r in found} == {sum(v for v in values if v is not None)}
    ranged = frame.repartitionByRange(F.desc_nulls_last("v"), "k")
    held = ranged.where(F.col("v") == common).groupBy(F.spark_partition_id()).count().collect()
    assert len(held) > 2 and max(r["count"] for r in held) < 120


def test_rows_and_summaries_read_one_shuffle(spark, many_ranges):
    frame = spark.createDataFrame([(n, Decimal(n % 9)) for n in range(90)], "k int, v decimal(20,2)")
    report = running_total(frame.groupBy("v").agg(F.count("k").alias("n")), "v")
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("Exchange rangepartitioning") == 1
    assert plan.count("Scan ExistingRDD") == 1


@pytest.mark.parametrize("values", [[], [None, None], [3], [2, 2, 2]])
def test_running_total_of_few_rows(spark, values):
    frame = spark.createDataFrame(list(enumerate(values)), "k int, v int")
    found = {(r.k, r.v): r.running for r in running_total(frame, "v").collect()}
    assert found == brute_running(values)
