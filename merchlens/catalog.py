"""The raw tables: columns, keys, references and file conventions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class TableSpec:
    """Typed columns of one raw table and the rules its rows obey."""

    name: str
    columns: Mapping[str, str]
    primary_key: tuple[str, ...] = ()
    references: Mapping[str, str] = field(default_factory=dict)
    """Foreign key column -> parent table; the parent column has the same name."""
    renames: Mapping[str, str] = field(default_factory=dict)
    """Column name in the file -> column name in the table."""
    multi_line: bool = False
    """Whether quoted fields of the file may hold line breaks (unsplittable read)."""

    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items())


# Names, types, keys and references of the raw tables.
_SPECS = (
    TableSpec(
        "customers",
        {
            "customer_id": "varchar(32)",
            "customer_unique_id": "varchar(32)",
            "customer_zip_code_prefix": "int",
            "customer_city": "varchar(50)",
            "customer_state": "varchar(2)",
        },
        primary_key=("customer_id",),
    ),
    TableSpec(
        "geolocation",
        {
            "geolocation_zip_code_prefix": "int",
            "geolocation_lat": "decimal(10,6)",
            "geolocation_lng": "decimal(10,6)",
            "geolocation_city": "varchar(50)",
            "geolocation_state": "varchar(2)",
        },
    ),
    TableSpec(
        "sellers",
        {
            "seller_id": "varchar(32)",
            "seller_zip_code_prefix": "int",
            "seller_city": "varchar(50)",
            "seller_state": "varchar(2)",
        },
        primary_key=("seller_id",),
    ),
    TableSpec(
        "products",
        {
            "product_id": "varchar(32)",
            "product_category": "varchar(50)",
            "product_name_length": "int",
            "product_description_length": "int",
            "product_photos_qty": "int",
            "product_weight_g": "decimal(10,2)",
            "product_length_cm": "decimal(6,2)",
            "product_height_cm": "decimal(6,2)",
            "product_width_cm": "decimal(6,2)",
        },
        primary_key=("product_id",),
        renames={"product category": "product_category"},
    ),
    TableSpec(
        "orders",
        {
            "order_id": "varchar(32)",
            "customer_id": "varchar(32)",
            "order_status": "varchar(15)",
            "order_purchase_timestamp": "timestamp_ntz",
            "order_approved_at": "timestamp_ntz",
            "order_delivered_carrier_date": "timestamp_ntz",
            "order_delivered_customer_date": "timestamp_ntz",
            "order_estimated_delivery_date": "timestamp_ntz",
        },
        primary_key=("order_id",),
        references={"customer_id": "customers"},
    ),
    TableSpec(
        "order_items",
        {
            "order_id": "varchar(32)",
            "order_item_id": "int",
            "product_id": "varchar(32)",
            "seller_id": "varchar(32)",
            "shipping_limit_date": "timestamp_ntz",
            "price": "decimal(6,2)",
            "freight_value": "decimal(5,2)",
        },
        primary_key=("order_id", "order_item_id"),
        references={"order_id": "orders", "product_id": "products", "seller_id": "sellers"},
    ),
    TableSpec(
        "payments",
        {
            "order_id": "varchar(32)",
            "payment_sequential": "int",
            "payment_type": "varchar(15)",
            "payment_installments": "int",
            "payment_value": "decimal(7,2)",
        },
        primary_key=("order_id", "payment_sequential"),
        references={"order_id": "orders"},
    ),
)

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}

# Read for profiling only; never loaded into the warehouse.
REVIEWS = TableSpec("reviews", {"star_rating": "int"}, multi_line=True)

# The timestamps of an order, in the order they happen.
ORDER_DATES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


class RawTables:
    """The raw layer as DataFrames, each made when it is first asked for.

    Tables are given as DataFrames, or as functions that return one, under their
    names: those of the catalogue, and `reviews`.
    """

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        self._given = tables
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._given:
            raise AttributeError(f"no table {name}")
        if name not in self._made:
            table = self._given[name]
            self._made[name] = table if isinstance(table, DataFrame) else table()
        return self._made[name]

    def replace(self, **tables: DataFrame | Callable[[], DataFrame]) -> RawTables:
        """Other tables under some names."""
        return RawTables(**{**self._given, **tables})

    def present(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self._given}


def load_waves(specs: Mapping[str, TableSpec]) -> list[list[str]]:
    """Table names in waves: each table comes after every table it references."""
    waves: list[list[str]] = []
    placed: set[str] = set()
    while len(placed) < len(specs):
        ready = [
            name
            for name, spec in specs.items()
            if name not in placed and placed.issuperset(spec.references.values())
        ]
        if not ready:
            raise ValueError("table references form a cycle")
        waves.append(ready)
        placed.update(ready)
    return waves


def dependants(specs: Mapping[str, TableSpec], name: str) -> list[str]:
    """Tables that reference `name` directly or through other tables."""
    found: list[str] = []
    for wave in load_waves(specs):
        for child in wave:
            parents = set(specs[child].references.values())
            if parents & {name, *found}:
                found.append(child)
    return found
