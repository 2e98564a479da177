"""The retail model over the sample star schema (orders, lineitem, part, ...)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.catalog import TABLES, RawTables, TableSpec


# The columns read from each sample file.
_COLUMNS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double, l_tax double, l_shipdate timestamp_ntz",
    "events": "event_id bigint",
}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One sample table. With its columns given, no job looks for them."""
    return spark.read.schema(_COLUMNS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def sample_specs() -> dict[str, TableSpec]:
    """The catalogue with the wider types that sample values need."""
    wider = {
        "customer_state": "varchar(25)",
        "seller_state": "varchar(25)",
        "geolocation_state": "varchar(25)",
        "price": "decimal(12,2)",
        "payment_value": "decimal(12,2)",
    }
    return {
        name: replace(spec, columns={c: wider.get(c, kind) for c, kind in spec.columns.items()})
        for name, spec in TABLES.items()
    }


def sample_tables(spark: SparkSession, folder: str) -> RawTables:
    def table(name: str) -> DataFrame:
        return _read(spark, folder, name)

    return RawTables(
        customers=lambda: _customers(table("customer"), table("nation")),
        sellers=lambda: _sellers(table("supplier"), table("nation")),
        products=lambda: _products(table("part")),
        orders=lambda: _orders(table("orders")),
        order_items=lambda: _order_items(table("lineitem")),
        payments=lambda: _payments(table("orders")),
        geolocation=lambda: _geolocation(table("supplier"), table("nation")),
        reviews=lambda: table("events").select(
            (F.col("event_id") % 5 + 1).cast("int").alias("star_rating")
        ),
    )


def with_deliveries(spark: SparkSession, folder: str) -> RawTables:
    """The same model with the customer delivery date, which needs every line item."""
    return sample_tables(spark, folder).replace(
        orders=lambda: _delivered(
            _read(spark, folder, "orders"), _read(spark, folder, "lineitem")
        )
    )


def _delivered(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders joined as they are in the file: what is made of them is not shuffled."""
    shipped = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("first_ship")
    )
    carrier = "(o_orderdate + interval 2 days)"
    gap = f"datediff(first_ship, {carrier} - interval 2 days)"
    days = f"if(o_orderkey % 5 <> 0, abs({gap}), {gap}) % 130"
    return _orders(
        orders.drop("o_totalprice").join(shipped, "o_orderkey", "left"),
        f"{carrier} + make_dt_interval({days}, cast(o_orderkey % 24 as int), 0, 0)",
    )


def _with_nation(frame: DataFrame, key: str, nation: DataFrame) -> DataFrame:
    """Rows with the name of their nation; those of no nation are left out."""
    return frame.join(nation, F.col(key) == F.col("n_nationkey"))


def _customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return _with_nation(customer, "c_nationkey", nation).selectExpr(
        "cast(c_custkey as string) as customer_id",
        "cast(c_custkey div 2 as string) as customer_unique_id",
        "cast(c_custkey % 100000 as int) as customer_zip_code_prefix",
        "concat(n_name, '-', c_custkey % 5) as customer_city",
        "n_name as customer_state",
    )


def _sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return _with_nation(supplier, "s_nationkey", nation).selectExpr(
        "cast(s_suppkey as string) as seller_id",
        "cast(s_suppkey % 100000 as int) as seller_zip_code_prefix",
        "concat(n_name, '-', s_suppkey % 3) as seller_city",
        "n_name as seller_state",
    )


def _geolocation(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return _with_nation(supplier, "s_nationkey", nation).selectExpr(
        "cast(s_suppkey % 100000 as int) as geolocation_zip_code_prefix",
        "cast(-s_nationkey as decimal(10,6)) as geolocation_lat",
        "cast(s_nationkey as decimal(10,6)) as geolocation_lng",
        "concat(n_name, '-', s_suppkey % 3) as geolocation_city",
        "n_name as geolocation_state",
    )


def _products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "cast(p_partkey as string) as product_id",
        "p_name as product_category",
        "length(p_name) as product_name_length",
        "length(p_type) as product_description_length",
        "p_size % 7 as product_photos_qty",
        "cast(p_size * 100 as decimal(10,2)) as product_weight_g",
        "cast(p_size as decimal(6,2)) as product_length_cm",
        "cast(p_size as decimal(6,2)) as product_height_cm",
        "cast(p_size % 7 + 1 as decimal(6,2)) as product_width_cm",
    )


def _orders(orders: DataFrame, delivered: str = "cast(null as timestamp_ntz)") -> DataFrame:
    hours = "make_dt_interval(0, cast(o_orderkey % 24 as int), 0, 0)"
    return orders.selectExpr(
        "cast(o_orderkey as string) as order_id",
        "cast(o_custkey as string) as customer_id",
        """case when o_orderkey % 50 = 7 then 'unavailable'
                when o_orderstatus = 'F' then 'delivered'
                when o_orderstatus = 'O' then 'shipped'
                when o_orderkey % 10 = 0 then 'canceled'
                else 'delivered' end as order_status""",
        f"o_orderdate + {hours} as order_purchase_timestamp",
        f"o_orderdate + {hours} + interval 1 hour as order_approved_at",
        "o_orderdate + interval 2 days as order_delivered_carrier_date",
        f"{delivered} as order_delivered_customer_date",
        "o_orderdate + interval 20 days as order_estimated_delivery_date",
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "cast(l_orderkey as string) as order_id",
        "l_linenumber as order_item_id",
        "cast(l_partkey as string) as product_id",
        "cast(l_suppkey as string) as seller_id",
        "l_shipdate as shipping_limit_date",
        "cast(l_extendedprice as decimal(12,2)) as price",
        "cast(l_tax * 100 as decimal(5,2)) as freight_value",
    )


def _payments(orders: DataFrame) -> DataFrame:
    """One payment per order, and a second one for every tenth order."""
    first = """named_struct(
        'payment_sequential', 1,
        'payment_type', elt(cast(o_orderkey % 4 + 1 as int),
                            'credit_card', 'boleto', 'voucher', 'debit_card'),
        'payment_installments', cast(1 + o_orderkey % 12 as int),
        'payment_value', cast(o_totalprice as decimal(12,2)))"""
    second = """named_struct(
        'payment_sequential', 2,
        'payment_type', 'voucher',
        'payment_installments', 1,
        'payment_value', cast(10 as decimal(12,2)))"""
    return orders.selectExpr(
        "cast(o_orderkey as string) as order_id",
        f"inline(if(o_orderkey % 10 = 0, array({first}, {second}), array({first})))",
    )
