"""Every report and check by name, as a function of a session and a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.catalog import ORDER_DATES, TABLES, RawTables
from merchlens.marts import delivery_mart, purchasing_power_mart, sales_mart
from merchlens.operators import checks
from merchlens.operators.metrics import METRICS
from merchlens.operators.periods import PERIODS
from merchlens.operators.table_profile import TableProfile
from merchlens.registry.stored import (
    cascaded_truncate,
    land_and_load,
    load_enforced,
    load_quarantined,
    load_rejected,
    load_reloaded,
    stored_warehouse,
)
from merchlens.reports import abc, logistics, profile, sales
from merchlens.session import configure
from merchlens.sinks import Warehouse
from merchlens.sources import sample_tables, with_deliveries

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        **{name: _on_tables(run) for name, run in _sales_queries().items()},
        **{name: _on_tables(run, deliveries=True) for name, run in _delivery_queries().items()},
        **{name: _on_tables(run, deliveries=True) for name, run in _check_queries().items()},
        **{name: _on_tables(run) for name, run in _profile_queries().items()},
        **_stored_queries(),
    }


def plain(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, ratios to four places, so that engines hand out one type."""

    def column(field: T.StructField):
        if not isinstance(field.dataType, T.DecimalType):
            return F.col(field.name)
        value = F.col(field.name)
        if field.dataType.scale > 4:
            value = F.round(value, 4)
        return value.cast("double").alias(field.name)

    return frame.select(*(column(field) for field in frame.schema))


def _on_tables(run: Callable[[RawTables], DataFrame], deliveries: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        model = with_deliveries if deliveries else sample_tables
        return plain(run(_model(model, configure(spark), folder)))

    return query


_models: dict[tuple[str, str, str], RawTables] = {}


def _model(model: Callable, spark: SparkSession, folder: str) -> RawTables:
    """The plans of the sample tables, made once in a session. They hold no rows."""
    application = spark.sparkContext.applicationId
    for stopped in [key for key in _models if key[1] != application]:
        del _models[stopped]
    made = (model.__name__, application, folder)
    if made not in _models:
        _models[made] = model(spark, folder)
    return _models[made]


def _with_unknown_period(raw: RawTables) -> DataFrame:
    """Orders of each trailing period, and of one that nobody knows."""
    found = [
        sales.kpi(raw, "orders", period).select(F.lit(period).alias("period"), "value")
        for period in (*PERIODS, "unknown")
    ]
    return reduce(DataFrame.unionByName, found)


def _sales_queries() -> dict[str, Callable[[RawTables], DataFrame]]:
    found = {
        "mart_sales": sales_mart,
        "mart_purchasing_power": purchasing_power_mart,
        "sales_monthly": sales.sales_monthly,
        "payment_methods": sales.payment_methods,
        "kpi_unknown_metric": lambda raw: sales.kpi_by_state(raw, "unknown", "last_year"),
        "kpi_unknown_period": _with_unknown_period,
        "pareto_category": lambda raw: abc.pareto(raw, "product_category"),
        "pareto_state": lambda raw: abc.pareto(raw, "customer_state"),
        "pareto_product": lambda raw: abc.pareto(raw, "product_id"),
        "pareto_seller": lambda raw: abc.pareto(raw, "seller_id"),
        "abc_category": lambda raw: abc.abc_classes(raw, "product_category"),
        "abc_category_amount": lambda raw: abc.abc_classes(
            raw, "product_category", with_amount=True
        ),
        "abc_category_revenue": lambda raw: abc.abc_revenue(raw, "product_category"),
        "abc_state": lambda raw: abc.abc_classes(raw, "customer_state", by_label=False),
        "abc_state_detail": lambda raw: abc.abc_detail(raw, "customer_state"),
    }
    by_metric = {
        "kpi": sales.kpi,
        "kpi_trend": sales.kpi_trend,
        "kpi_by_state": sales.kpi_by_state,
        "top_categories": sales.top_categories,
    }
    for (name, report), metric, period in product(by_metric.items(), METRICS, PERIODS):
        found[f"{name}_{metric}_{period}"] = lambda raw, r=report, m=metric, p=period: r(raw, m, p)
    return found


def _delivery_queries() -> dict[str, Callable[[RawTables], DataFrame]]:
    return {
        "mart_delivery": delivery_mart,
        "late_share": logistics.late_share,
        "delivery_trend": lambda raw: logistics.delivery_trend(raw.orders),
        "delivery_median": lambda raw: logistics.delivery_median(raw.orders),
        "delivery_by_state": logistics.delivery_by_state,
        "delivery_histogram": logistics.delivery_histogram,
        "problem_routes": logistics.problem_routes,
        "fastest_cities": logistics.fastest_cities,
    }


def _check_queries() -> dict[str, Callable[[RawTables], DataFrame]]:
    return {
        "dq_shapes": lambda raw: checks.table_shapes(raw.present()),
        "dq_missing": lambda raw: _each_table(raw, lambda _, frame: checks.missing_values(frame)),
        "dq_pk": checks.pk_checks,
        "dq_fk": checks.fk_checks,
        "dq_keys": checks.key_checks,
        "dq_profile": lambda raw: _each_table(raw, lambda _, table: TableProfile.of(table).overview()),
        "dq_date_ranges": lambda raw: checks.date_ranges(raw.orders),
        "value_counts_status": lambda raw: checks.value_counts(raw.orders, "order_status"),
        "value_counts_payment_type": lambda raw: checks.value_counts(raw.payments, "payment_type"),
    }


def _profile_queries() -> dict[str, Callable[[RawTables], DataFrame]]:
    return {
        # Without customer delivery dates, which would need every line item.
        "dq_schema_preview": lambda raw: _each_table(raw, _preview),
        "total_revenue": lambda raw: profile.total_revenue(raw.order_items),
        "avg_order_value_items": lambda raw: profile.avg_order_value_items(raw.order_items),
        "entity_counts": profile.entity_counts,
        "top_categories_items": lambda raw: profile.top_categories_items(
            raw.order_items, raw.products
        ),
        "rating_distribution": lambda raw: profile.rating_distribution(raw.reviews),
    }


def _stored_queries() -> dict[str, Query]:
    """Reports over marts that were loaded and stored first, as a dashboard reads them."""
    on_sales = {
        "stored_sales_monthly": sales.sales_monthly,
        "stored_kpi_turnover_last_month": lambda s: sales.kpi(s, "turnover", "last_month"),
        "stored_kpi_trend_aov_last_year": lambda s: sales.kpi_trend(s, "aov", "last_year"),
        "stored_top_categories_customers_last_quarter": lambda s: sales.top_categories(
            s, "customers", "last_quarter"
        ),
        "stored_payment_methods": sales.payment_methods,
        "stored_abc_category": lambda s: abc.abc_classes(s, "product_category"),
        "stored_abc_category_revenue": lambda s: abc.abc_revenue(s, "product_category"),
        "stored_abc_state": lambda s: abc.abc_classes(s, "customer_state", by_label=False),
        "stored_abc_state_detail": lambda s: abc.abc_detail(s, "customer_state"),
        "stored_pareto_category": lambda s: abc.pareto(s, "product_category"),
        "stored_pareto_state": lambda s: abc.pareto(s, "customer_state"),
    }
    for metric, period in (("turnover", "last_month"), ("arpu", "last_year")):
        on_sales[f"stored_kpi_by_state_{metric}_{period}"] = lambda s, m=metric, p=period: (
            sales.kpi_by_state(s, m, p)
        )
    on_delivery = {
        "stored_late_share": logistics.late_share,
        "stored_delivery_by_state": logistics.delivery_by_state,
        "stored_delivery_histogram": logistics.delivery_histogram,
        "stored_fastest_cities": logistics.fastest_cities,
        "stored_problem_routes": logistics.problem_routes,
    }
    on_orders = {
        "stored_delivery_trend": logistics.delivery_trend,
        "stored_delivery_median": logistics.delivery_median,
    }

    on_profiles = {
        "stored_dq_shapes": lambda house: _profiles(house, TableProfile.shape),
        "stored_dq_missing": lambda house: _profiles(house, TableProfile.missing_values),
        "stored_dq_date_ranges": lambda house: house.profile("orders").ranges(ORDER_DATES),
        "stored_value_counts_status": lambda house: house.profile("orders").value_counts(
            "order_status"
        ),
        "stored_value_counts_payment_type": lambda house: house.profile("payments").value_counts(
            "payment_type"
        ),
    }
    on_loaded = {
        "loaded_kpi_turnover_last_month": lambda s: sales.kpi(s, "turnover", "last_month"),
        "loaded_kpi_trend_aov_last_year": lambda s: sales.kpi_trend(s, "aov", "last_year"),
        "loaded_top_categories_customers_last_quarter": lambda s: sales.top_categories(
            s, "customers", "last_quarter"
        ),
    }

    def house_query(run) -> Query:
        return lambda spark, folder: plain(run(stored_warehouse(spark, folder)))

    def loaded_query(run) -> Query:
        """Reports on a warehouse's raw tables, by what their loads recorded."""
        return lambda spark, folder: plain(run(stored_warehouse(spark, folder).raw_sales()))

    def sales_query(run) -> Query:
        return lambda spark, folder: plain(run(stored_warehouse(spark, folder).sales()))

    def delivery_query(run) -> Query:
        return lambda spark, folder: plain(run(stored_warehouse(spark, folder).delivery()))

    def orders_query(run) -> Query:
        return lambda spark, folder: plain(run(stored_warehouse(spark, folder).tables().orders))

    def pruned_sql(spark: SparkSession, folder: str) -> DataFrame:
        """Turnover by month from the view of the mart, as a SQL user would ask for it."""
        view = f"{stored_warehouse(spark, folder).dm}.sales"
        return plain(
            spark.sql(
                "select cast(purchase_month as timestamp_ntz) as month, "
                "sum(payment_value) as turnover "
                f"from {view} where purchase_month >= date'1997-01-01' group by purchase_month"
            )
        )

    return {
        "load_roundtrip": land_and_load,
        "load_enforced": load_enforced,
        "load_rejected": load_rejected,
        "load_quarantined": load_quarantined,
        "load_reloaded": load_reloaded,
        "truncate_cascade": cascaded_truncate,
        "stored_turnover_by_month": pruned_sql,
        **{name: orders_query(run) for name, run in on_orders.items()},
        **{name: house_query(run) for name, run in on_profiles.items()},
        **{name: loaded_query(run) for name, run in on_loaded.items()},
        **{name: sales_query(run) for name, run in on_sales.items()},
        **{name: delivery_query(run) for name, run in on_delivery.items()},
    }


def _each_table(raw: RawTables, check: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    found = [
        check(name, frame).select(F.lit(name).alias("table_name"), "*")
        for name, frame in raw.present().items()
    ]
    return reduce(DataFrame.unionByName, found)


def _profiles(house: Warehouse, check: Callable[[TableProfile], DataFrame]) -> DataFrame:
    found = [
        check(house.profile(name)).select(F.lit(name).alias("table_name"), "*") for name in TABLES
    ]
    return reduce(DataFrame.unionByName, found)


def _preview(name: str, frame: DataFrame) -> DataFrame:
    """The overview of a table by its key, with the first values as one text."""
    key = TABLES[name].primary_key if name in TABLES else ()
    # The sample repeats item numbers, so all columns settle the order.
    order = [*key, *(column for column in frame.columns if column not in key)]
    overview = checks.schema_overview(frame, order)
    return overview.withColumn("preview", F.array_join("preview", ", "))
