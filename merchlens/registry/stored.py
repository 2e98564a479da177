"""The sample tables taken through landing files, typed tables and stored marts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.catalog import TABLES, RawTables
from merchlens.session import configure, delete_folder, warehouse_folder
from merchlens.sinks import ConstraintError, Warehouse, land_csv
from merchlens.sources import (
    read_raw,
    read_split,
    sample_specs,
    sample_tables,
    with_deliveries,
)

_built: dict[str, Warehouse] = {}


def land_and_load(spark: SparkSession, folder: str) -> DataFrame:
    """Write every raw table as CSV, read the files back typed, and load them.

    Keys and references are counted rather than enforced: the sample has item
    numbers that repeat within an order. Sellers' cities get blanks at their edges,
    which have to survive. What was written is dropped again.
    """
    configure(spark)
    tables = with_deliveries(spark, folder)
    padded = tables.sellers.withColumn("seller_city", F.concat(F.lit("  "), "seller_city"))
    root, house, report = _load(spark, tables.replace(sellers=padded))
    edges = house.tables().sellers.where(~F.col("seller_city").startswith("  ")).count()
    _drop(spark, root, house)
    return report.withColumn(
        "trimmed", F.when(F.col("table_name") == "sellers", edges).otherwise(0).cast("bigint")
    )


def load_enforced(spark: SparkSession, folder: str) -> DataFrame:
    """A load with keys and references enforced, and the sales it then reports.

    Items are numbered anew within their orders, so that their keys are unique.
    """
    configure(spark)
    root, house, report = _load(spark, _numbered(with_deliveries(spark, folder)), enforce=True)
    _drop(spark, root, house)
    return report


def load_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """What is left after a load that its item keys forbid: rows of every table, and why."""
    configure(spark)
    root, house, _ = _load(spark, _numbered(sample_tables(spark, folder)), enforce=True)
    broken = sample_tables(spark, folder).order_items
    repeated = broken.withColumn("order_item_id", F.lit(1))
    kept = {name: spark.table(f"{house.raw}.{name}").count() for name in TABLES}
    try:
        house.load_table("order_items", repeated)
        refused = 0
    except ConstraintError:
        refused = 1
    after = {name: spark.table(f"{house.raw}.{name}").count() for name in TABLES}
    _drop(spark, root, house)
    return spark.createDataFrame(
        [
            (name, after[name], kept[name] - after[name], refused * (name == "order_items"))
            for name in TABLES
        ],
        "table_name string, rows bigint, lost bigint, refused bigint",
    )


def load_quarantined(spark: SparkSession, folder: str) -> DataFrame:
    """Files with values that their types cannot hold: what is loaded, and what is kept out.

    A row for each table, with the lines of its file in `rows` and `rejected_rows`
    together, and one for each column and reason, with the rejected values.
    """
    configure(spark)
    tables = with_deliveries(spark, folder)
    number = F.col("order_id").cast("bigint")
    broken = tables.replace(
        payments=tables.payments.withColumns(
            {
                "payment_value": F.when(number % 97 == 3, "12,50").otherwise(
                    F.col("payment_value").cast("string")
                ),
                "payment_installments": F.when(number % 89 == 3, "twelve").otherwise(
                    F.col("payment_installments").cast("string")
                ),
            }
        ),
        sellers=tables.sellers.withColumn(
            "seller_city",
            F.when(
                F.col("seller_id").cast("bigint") % 10 == 1, F.repeat(F.lit("x"), F.lit(60))
            ).otherwise(F.col("seller_city")),
        ),
        orders=tables.orders.withColumn(
            "order_approved_at",
            F.when(number % 101 == 5, "2001-13-45 00:00:00").otherwise(
                F.col("order_approved_at").cast("string")
            ),
        ),
    )
    root, house, _ = _load(spark, broken, read=read_split)
    whole = [F.lit("").alias(name) for name in ("column_name", "reason")]
    counts = house.row_counts().select("table_name", *whole, "rows", "rejected_rows")
    reasons = (
        house.rejections()
        .groupBy("table_name", "column_name", "reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
        .withColumn("rows", F.lit(0).cast("bigint"))
    )
    found = spark.createDataFrame(counts.unionByName(reasons).collect(), counts.schema)
    _drop(spark, root, house)
    return found


def load_reloaded(spark: SparkSession, folder: str) -> DataFrame:
    """Rows after orders are loaded anew, twice, with the tables that need them.

    First the same orders, all approved, over items and payments as they are; then only
    orders with an even number, with items and payments that go with them.
    """
    configure(spark)
    tables = sample_tables(spark, folder)
    root, house, _ = _load(spark, _numbered(tables), enforce=True)
    approved = tables.orders.withColumn("order_status", F.lit("approved"))
    house.load_table("orders", approved, reload=True)
    kept = {name: spark.table(f"{house.raw}.{name}").count() for name in TABLES}
    raw = house.tables()
    even = F.col("order_id").cast("bigint") % 2 == 0
    house.load_table(
        "orders", approved.where(even), reload=lambda name: getattr(raw, name).where(even)
    )
    checked = house.raw_sales().keys_enforced
    report = [
        (name, kept[name], spark.table(f"{house.raw}.{name}").count(), checked) for name in TABLES
    ]
    _drop(spark, root, house)
    return spark.createDataFrame(
        report, "table_name string, kept_rows bigint, rows bigint, checked boolean"
    )


def cascaded_truncate(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table after customers are emptied, and with them all that needs them."""
    configure(spark)
    root, house, _ = _load(spark, sample_tables(spark, folder))
    house.truncate("customers")
    counts = [(name, spark.table(f"{house.raw}.{name}").count()) for name in TABLES]
    _drop(spark, root, house)
    return spark.createDataFrame(counts, "table_name string, rows bigint")


def stored_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """A loaded warehouse with marts, built on first use in a session; see `release`."""
    configure(spark)
    application = spark.sparkContext.applicationId
    for made in [key for key in _built if not key.startswith(application)]:
        del _built[made]
    built = f"{application} {folder}"
    if built not in _built:
        _, warehouse, _ = _load(spark, with_deliveries(spark, folder))
        warehouse.build_marts()
        _built[built] = warehouse
    return _built[built]


def release(spark: SparkSession) -> None:
    """Drop the warehouses that stored queries of this session have built."""
    application = spark.sparkContext.applicationId
    for made in [key for key in _built if key.startswith(application)]:
        _built.pop(made).drop()


def _numbered(tables: RawTables) -> RawTables:
    """Items numbered 1, 2, ... within their order."""
    within = Window.partitionBy("order_id").orderBy("order_item_id", "product_id", "seller_id")
    return tables.replace(
        order_items=tables.order_items.withColumn("order_item_id", F.row_number().over(within))
    )


def _load(
    spark: SparkSession, tables: RawTables, enforce: bool = False, read: Callable = read_raw
) -> tuple[str, Warehouse, DataFrame]:
    """Land all tables at once, then load them below the session's warehouse folder."""
    specs = sample_specs()
    root = warehouse_folder(spark, "sample")
    frames = {name: getattr(tables, name) for name in TABLES}
    with ThreadPoolExecutor(4) as pool:
        land = lambda name: land_csv(
            frames[name], f"{root}/landing", name, compression="lz4"
        )
        paths = pool.map(land, TABLES)
        landed = dict(zip(TABLES, paths))
    tag = uuid.uuid4().hex[:8]
    warehouse = Warehouse(spark, root, specs, raw=f"raw_{tag}", dm=f"dm_{tag}")
    report = warehouse.load_all(
        lambda name: read(spark, landed[name], specs[name]), enforce=enforce
    )
    delete_folder(spark, f"{root}/landing")
    return root, warehouse, report


def _drop(spark: SparkSession, root: str, warehouse: Warehouse) -> None:
    warehouse.drop()
    delete_folder(spark, root)
