"""DuckDB SQL that gives the result of each registered query from the sample tables.

The sales SQL sums over the joined pairs of items and payments, which the Spark
reports avoid, so the two ways check each other.
"""

from __future__ import annotations

import re
from itertools import product

from merchlens.catalog import ORDER_DATES, TABLES, dependants
from merchlens.fixed_values import (
    ABC_A_UNTIL,
    ABC_B_UNTIL,
    DELIVERED_STATUS,
    DELIVERY_BUCKET_BEYOND,
    DELIVERY_BUCKETS,
    INACTIVE_STATUSES,
    LATE_DAYS,
    PERIOD_MONTHS,
    PROBLEM_ROUTE_DAYS,
)
from merchlens.operators.metrics import METRICS
from merchlens.operators.periods import PERIODS

_TABLES = {
    "customers": """
        select cast(c_custkey as varchar) customer_id,
               cast(c_custkey // 2 as varchar) customer_unique_id,
               cast(c_custkey % 100000 as integer) customer_zip_code_prefix,
               n_name || '-' || (c_custkey % 5) customer_city, n_name customer_state
        from customer join nation on c_nationkey = n_nationkey""",
    "sellers": """
        select cast(s_suppkey as varchar) seller_id,
               cast(s_suppkey % 100000 as integer) seller_zip_code_prefix,
               n_name || '-' || (s_suppkey % 3) seller_city, n_name seller_state
        from supplier join nation on s_nationkey = n_nationkey""",
    "geolocation": """
        select cast(s_suppkey % 100000 as integer) geolocation_zip_code_prefix,
               cast(-s_nationkey as decimal(10,6)) geolocation_lat,
               cast(s_nationkey as decimal(10,6)) geolocation_lng,
               n_name || '-' || (s_suppkey % 3) geolocation_city, n_name geolocation_state
        from supplier join nation on s_nationkey = n_nationkey""",
    "reviews": "select cast(event_id % 5 + 1 as integer) star_rating from events",
    "products": """
        select cast(p_partkey as varchar) product_id, p_name product_category,
               cast(length(p_name) as integer) product_name_length,
               cast(length(p_type) as integer) product_description_length,
               cast(p_size % 7 as integer) product_photos_qty,
               cast(p_size * 100 as decimal(10,2)) product_weight_g,
               cast(p_size as decimal(6,2)) product_length_cm,
               cast(p_size as decimal(6,2)) product_height_cm,
               cast(p_size % 7 + 1 as decimal(6,2)) product_width_cm from part""",
    "shipped": "select l_orderkey, min(l_shipdate) first_ship from lineitem group by l_orderkey",
    "spans": """
        select o.*, date_diff('day', o_orderdate, first_ship) raw_d
        from main.orders o left join shipped on l_orderkey = o_orderkey""",
    "placed": """
        select cast(o_orderkey as varchar) order_id, cast(o_custkey as varchar) customer_id,
               case when o_orderkey % 50 = 7 then 'unavailable'
                    when o_orderstatus = 'F' then 'delivered'
                    when o_orderstatus = 'O' then 'shipped'
                    when o_orderkey % 10 = 0 then 'canceled'
                    else 'delivered' end order_status,
               o_orderdate + to_hours(o_orderkey % 24) order_purchase_timestamp,
               o_orderdate + to_hours(o_orderkey % 24 + 1) order_approved_at,
               o_orderdate + interval 2 day order_delivered_carrier_date,
               o_orderdate + interval 2 day
                 + to_days(cast((case when o_orderkey % 5 <> 0 then abs(raw_d) else raw_d end)
                                % 130 as integer))
                 + to_hours(o_orderkey % 24) order_delivered_customer_date,
               o_orderdate + interval 20 day order_estimated_delivery_date
        from spans""",
    "items": """
        select cast(l_orderkey as varchar) order_id, l_linenumber order_item_id,
               cast(l_partkey as varchar) product_id, cast(l_suppkey as varchar) seller_id,
               l_shipdate shipping_limit_date,
               cast(l_extendedprice as decimal(12,2)) price,
               cast(l_tax * 100 as decimal(5,2)) freight_value
        from lineitem""",
    "payments": """
        select cast(o_orderkey as varchar) order_id, 1 payment_sequential,
               ['credit_card', 'boleto', 'voucher', 'debit_card'][o_orderkey % 4 + 1] payment_type,
               cast(1 + o_orderkey % 12 as integer) payment_installments,
               cast(o_totalprice as decimal(12,2)) payment_value
        from main.orders
        union all
        select cast(o_orderkey as varchar), 2, 'voucher', 1, cast(10 as decimal(12,2))
        from main.orders where o_orderkey % 10 = 0""",
    "sales": """
        select order_id, order_purchase_timestamp, order_status, product_category, customer_id,
               customer_city, customer_state, seller_city, seller_state, price, freight_value,
               payment_type, payment_value, product_id, seller_id
        from items join placed using (order_id) join payments using (order_id)
             join customers using (customer_id) join products using (product_id)
             join sellers using (seller_id)""",
    "sold": f"select * from sales where order_status not in {INACTIVE_STATUSES}",
    # Whole days and hours left of a difference: both truncated toward zero.
    "delivery": """
        select order_id, seller_id, seller_state, seller_city, order_delivered_carrier_date,
               customer_id, customer_state, customer_city, order_delivered_customer_date,
               extract(day from transit) delivery_days, extract(hour from transit) delivery_hours,
               extract(day from transit) || ' days ' || extract(hour from transit) || ' hours'
                 delivery_time
        from (select *, order_delivered_customer_date - order_delivered_carrier_date transit
              from placed)
             join items using (order_id) join customers using (customer_id)
             join sellers using (seller_id)
        where transit is not null""",
}


def _query(body: str) -> str:
    """The body after the definitions it needs, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"(?:from|join)\s+(\w+)\b(?!\.)", text):
            if word in _TABLES and word not in needed:
                visit(_TABLES[word])
                needed.append(word)

    visit(body)
    if not needed:
        return body
    return "with " + ",\n".join(f"{name} as ({_TABLES[name]})" for name in needed) + "\n" + body


def _rounded(numerator: str, denominator: str, digits: int) -> str:
    """Quotient of whole numbers, rounded half up to `digits`, in whole numbers."""
    scaled = f"(2 * {10**digits} * ({numerator}) + ({denominator}))"
    return f"cast({scaled} // (2 * ({denominator})) as double) / {10**digits}"


def _cents(amount: str) -> str:
    return f"cast({amount} * 100 as hugeint)"


def _per(amount: str, count: str) -> str:
    """Amount per counted thing to four places; NULL over an empty count."""
    return _rounded(_cents(amount), f"nullif(100 * {count}, 0)", 4)


def _share(part: str, whole: str, digits: int) -> str:
    return _rounded(f"100 * {part}", f"{whole}", digits)


def _labelled(value: str, part: str, whole: str) -> str:
    """Value and its percent of the whole with two decimals, as text."""
    hundredths = f"((20000 * {part} + {whole}) // (2 * {whole}))"
    return (
        f"{value} || ' (' || ({hundredths} // 100) || '.' "
        f"|| lpad(cast({hundredths} % 100 as varchar), 2, '0') || '%)'"
    )


_METRIC_SQL = {
    "turnover": "cast(sum(payment_value) as double)",
    "net_revenue": "cast(sum(price) as double)",
    "orders": "count(distinct order_id)",
    "customers": "count(distinct customer_id)",
    "aov": _per("sum(payment_value)", "count(distinct order_id)"),
    "arpu": _per("sum(payment_value)", "count(distinct customer_id)"),
}


def _recent(period: str) -> str:
    months = PERIOD_MONTHS[period]
    return (
        "from sold where order_purchase_timestamp >= "
        f"(select max(order_purchase_timestamp) - interval {months} month from sales)"
    )


def _metric_queries() -> dict[str, str]:
    found = {}
    for metric, period in product(METRICS, PERIODS):
        value, rows, tail = _METRIC_SQL[metric], _recent(period), f"{metric}_{period}"
        unit = "month" if period == "last_year" else "week"
        bucket = f"cast(date_trunc('{unit}', order_purchase_timestamp) as timestamp)"
        found[f"kpi_{tail}"] = _query(f"select {value} as value {rows}")
        found[f"kpi_trend_{tail}"] = _query(
            f"select {bucket} as period_date, {value} as value {rows} group by 1"
        )
        found[f"kpi_by_state_{tail}"] = _query(
            f"select customer_state, {value} as value {rows} group by 1"
        )
        found[f"top_categories_{tail}"] = _query(
            f"select product_category, {value} as value {rows} group by 1 "
            "order by 2 desc nulls first, 1 nulls last limit 10"
        )
    return found


def _pareto(key: str) -> str:
    return f"""(
        select *, {_share("cents", "total_cents", 3)} pct_total,
               {_share("running", "total_cents", 3)} cumulative_pct,
               case when cumulative_pct <= {ABC_A_UNTIL} then 'A'
                    when cumulative_pct <= {ABC_B_UNTIL} then 'B'
                    else 'C' end abc_group
        from (select k.*, {_cents("revenue")} cents, {_cents("total_revenue")} total_cents,
                     {_cents("(select sum(o.revenue) from per_key o where o.revenue >= k.revenue)")}
                       running
              from (select *, (select sum(revenue) from per_key) total_revenue from per_key) k))"""


def _abc_queries() -> dict[str, str]:
    def over(key: str, body: str) -> str:
        per_key = f"""per_key as (
            select {key}, sum(price) revenue, sum(payment_value) cash_flow,
                   count(distinct order_id) orders from sold group by 1)"""
        text = _query("select 1 from sold").removesuffix("select 1 from sold")
        return f"{text.rstrip()},\n{per_key}\n{body.replace('PARETO', _pareto(key))}"

    def pareto(key: str) -> str:
        return over(
            key,
            f"""select {key}, cast(revenue as double) revenue,
                       cast(total_revenue as double) total_revenue, pct_total, cumulative_pct,
                       cast(cash_flow as double) cash_flow, orders,
                       {_per("revenue", "orders")} aov
                from PARETO""",
        )

    def classes(key: str, extra: str = "") -> str:
        members = _labelled("members", "members", "sum(members) over ()")
        revenue = _labelled("class_revenue", "class_cents", "sum(class_cents) over ()")
        return over(
            key,
            f"""select abc_group, {members.replace("sum(members) over ()", "all_members")} members,
                       {revenue.replace("sum(class_cents) over ()", "all_cents")} revenue,
                       cast(cash_flow as double) cash_flow, cast(orders as bigint) orders,
                       aov{extra}
                from (select *, cast(sum(members) over () as bigint) all_members,
                             cast(sum(class_cents) over () as hugeint) all_cents
                      from (select abc_group, count({key}) members, sum(revenue) class_revenue,
                                   cast(sum(cents) as hugeint) class_cents,
                                   sum(cash_flow) cash_flow, sum(orders) orders,
                                   round(avg(revenue / orders), 4) aov
                            from PARETO group by abc_group))""",
        )

    revenue = _labelled("revenue", "cents", "total_cents")
    return {
        "pareto_category": pareto("product_category"),
        "pareto_state": pareto("customer_state"),
        "pareto_product": pareto("product_id"),
        "pareto_seller": pareto("seller_id"),
        "abc_category": classes("product_category"),
        "abc_category_amount": classes(
            "product_category", ", cast(class_revenue as double) revenue_amount"
        ),
        "abc_state": classes("customer_state"),
        "abc_category_revenue": over(
            "product_category",
            "select abc_group, cast(sum(revenue) as double) revenue from PARETO group by 1",
        ),
        "abc_state_detail": over(
            "customer_state",
            f"""select abc_group, customer_state, {revenue} revenue,
                       cast(cash_flow as double) cash_flow, orders,
                       {_per("revenue", "orders")} aov
                from PARETO""",
        ),
    }


def _sales_queries() -> dict[str, str]:
    return {
        "mart_sales": _query(
            "select * exclude (product_id, seller_id) replace (cast(price as double) as price, "
            "cast(freight_value as double) as freight_value, "
            "cast(payment_value as double) as payment_value) from sales"
        ),
        "mart_purchasing_power": _query(
            "select customer_id, customer_unique_id, customer_state, customer_city, payment_type, "
            "payment_installments, cast(payment_value as double) payment_value, order_id, "
            "order_purchase_timestamp from customers join placed using (customer_id) "
            f"join payments using (order_id) where order_status = '{DELIVERED_STATUS}'"
        ),
        "sales_monthly": _query(
            "select cast(date_trunc('month', order_purchase_timestamp) as timestamp) as month, "
            "cast(sum(price) as double) net_revenue, cast(sum(payment_value) as double) turnover, "
            "count(distinct order_id) orders from sales group by 1"
        ),
        "payment_methods": _query(
            "select payment_type, "
            + ", ".join(f"{_METRIC_SQL[metric]} as {metric}" for metric in METRICS)
            + " from sold group by 1"
        ),
        "kpi_unknown_metric": _query(
            f"select customer_state, cast(null as double) as value {_recent('last_year')} group by 1"
        ),
        "kpi_unknown_period": _query(
            " union all ".join(
                f"select '{period}' as period, count(distinct order_id) as value {_recent(period)}"
                for period in PERIODS
            )
            + " union all select 'unknown', 0"
        ),
    }


def _delivery_queries() -> dict[str, str]:
    bounds = " ".join(f"when delivery_days < {n} then '{label}'" for n, label in DELIVERY_BUCKETS)
    days = "cast(sum(delivery_days) as double) / count(*)"
    trend = (
        "from placed where order_delivered_customer_date is not null "
        "and order_delivered_carrier_date is not null"
    )
    transit = "extract(day from order_delivered_customer_date - order_delivered_carrier_date)"
    return {
        "mart_delivery": _query("select * from delivery"),
        "late_share": _query(
            f"select cast(100 * count(distinct case when delivery_days > {LATE_DAYS} then order_id end) "
            "// count(distinct order_id) as double) / 100 as late_share from delivery"
        ),
        "delivery_trend": _query(
            "select cast(date_trunc('month', order_delivered_customer_date) as timestamp) as month,"
            f" cast(sum({transit}) as double) / count(*) avg_delivery_days {trend} group by 1"
        ),
        "delivery_median": _query(
            f"select cast(median({transit}) as double) median_delivery_days {trend}"
        ),
        "delivery_by_state": _query(
            f"select customer_state, {days} avg_delivery_days from delivery group by 1"
        ),
        "delivery_histogram": _query(
            f"select case {bounds} else '{DELIVERY_BUCKET_BEYOND}' end delivery_bucket, "
            "count(distinct order_id) deliveries from delivery group by 1"
        ),
        "problem_routes": _query(
            "select * from (select seller_city || ' -> ' || customer_city route, seller_state, "
            f"customer_state, {days} avg_delivery_days, count(distinct order_id) orders "
            f"from delivery group by 1, 2, 3) where avg_delivery_days > {PROBLEM_ROUTE_DAYS}"
        ),
        "fastest_cities": _query(
            f"select seller_city, {days} avg_delivery_days, count(distinct order_id) deliveries "
            "from delivery group by 1 order by 2, 1 limit 10"
        ),
    }


def _check_queries() -> dict[str, str]:
    # Columns of each table, and the SQL name it has here.
    shapes = {
        "customers": ("customers", 5),
        "sellers": ("sellers", 4),
        "products": ("products", 9),
        "orders": ("placed", 8),
        "order_items": ("items", 7),
        "payments": ("payments", 5),
        "geolocation": ("geolocation", 5),
        "reviews": ("reviews", 1),
    }
    keys = {
        "customers": ("customers", "customer_id"),
        "sellers": ("sellers", "seller_id"),
        "products": ("products", "product_id"),
        "orders": ("placed", "order_id"),
        "order_items": ("items", "order_id, order_item_id"),
        "payments": ("payments", "order_id, payment_sequential"),
    }
    relations = {
        "orders.customer_id": ("placed", "customers", "customer_id"),
        "order_items.order_id": ("items", "placed", "order_id"),
        "order_items.product_id": ("items", "products", "product_id"),
        "order_items.seller_id": ("items", "sellers", "seller_id"),
        "payments.order_id": ("payments", "placed", "order_id"),
    }
    counted = (
        ("customers", "customer_unique_id", "customers"),
        ("sellers", "seller_id", "sellers"),
        ("products", "product_id", "products"),
    )

    layouts = {name: dict(spec.columns) for name, spec in TABLES.items()}
    layouts["reviews"] = {"star_rating": "int"}

    emptied = ("customers", *dependants(TABLES, "customers"))

    def stacked(parts) -> str:
        return _query(" union all ".join(parts))

    def previews():
        """First three rows by key and then all columns; texts, amounts and times as Spark's."""
        wider = {"price": "decimal(12,2)", "payment_value": "decimal(12,2)"}
        for name, columns in layouts.items():
            key = TABLES[name].primary_key if name in TABLES else ()
            # The preview reads orders without the date that line items give.
            hidden = " replace (cast(null as timestamp) as order_delivered_customer_date)"
            rows = f"select *{hidden if name == 'orders' else ''} from {shapes[name][0]}"
            order = [*key, *(column for column in columns if column not in key)]
            by = ", ".join(f"{column} nulls first" for column in order)
            for column, kind in columns.items():
                shown = f"coalesce(cast({column} as varchar), 'NULL')"
                kind = "string" if kind.startswith("varchar") else wider.get(column, kind)
                yield (
                    f"select '{name}' table_name, '{column}' column_name, '{kind}' data_type, "
                    f"string_agg({shown}, ', ' order by place) preview from (select *, "
                    f"row_number() over (order by {by}) place from ({rows})) where place <= 3"
                )

    def profiled():
        """Every column of every table: rows, NULLs, smallest and largest value as text."""
        wider = {"price": "decimal(12,2)", "payment_value": "decimal(12,2)"}
        for name, columns in layouts.items():
            for at, (column, kind) in enumerate(columns.items()):
                kind = "string" if kind.startswith("varchar") else wider.get(column, kind)
                yield (
                    f"select '{name}' table_name, {at} as position, '{column}' column_name, "
                    f"'{kind}' data_type, count(*) as rows, count(*) - count({column}) missing, "
                    f"cast(min({column}) as varchar) smallest, cast(max({column}) as varchar) largest "
                    f"from {shapes[name][0]}"
                )

    def keyed():
        for name, (table, key) in keys.items():
            orphans = " + ".join(
                f"(select count(distinct {column}) from {table} where {column} not in "
                f"(select {column} from {keys[parent][0]}))"
                for column, parent in TABLES[name].references.items()
            )
            yield (
                f"select '{name}' table_name, cast(sum(held) as bigint) as rows, count(*) unique_keys, "
                f"cast(sum(held - 1) as bigint) duplicate_rows, cast(0 as bigint) null_keys, "
                f"{orphans or 'cast(0 as bigint)'} orphan_keys "
                f"from (select count(*) held from {table} group by {key})"
            )

    # Which values `load_quarantined` breaks.
    number = "cast(order_id as bigint)"
    broken = {
        "payments": {
            "payment_value": (f"{number} % 97 = 3", "decimal(12,2)"),
            "payment_installments": (f"{number} % 89 = 3", "int"),
        },
        "sellers": {"seller_city": ("cast(seller_id as bigint) % 10 = 1", "varchar(50)")},
        "orders": {"order_approved_at": (f"{number} % 101 = 5", "timestamp_ntz")},
    }

    def quarantined():
        for name in TABLES:
            bad = " or ".join(where for where, _ in broken.get(name, {}).values()) or "false"
            yield (
                f"select '{name}' table_name, '' column_name, '' reason, "
                f"count(*) filter (where not ({bad})) as rows, count(*) filter (where {bad}) "
                f"rejected_rows from {shapes[name][0]}"
            )
            for column, (where, kind) in broken.get(name, {}).items():
                yield (
                    f"select '{name}', '{column}', 'not of type {kind}', cast(0 as bigint), count(*) "
                    f"from {shapes[name][0]} where {where} having count(*) > 0"
                )

    def reloaded():
        for name in TABLES:
            even = f"{number} % 2 = 0" if name in ("orders", "order_items", "payments") else "true"
            yield (
                f"select '{name}' table_name, count(*) kept_rows, count(*) filter (where {even}) as rows, "
                f"true checked from {shapes[name][0]}"
            )

    return {
        "dq_profile": stacked(profiled()),
        "dq_keys": stacked(keyed()),
        "load_quarantined": stacked(quarantined()),
        "load_reloaded": stacked(reloaded()),
        "stored_dq_shapes": stacked(
            f"select '{name}' table_name, count(*) as rows, "
            f"cast({shapes[name][1]} as bigint) cols from {shapes[name][0]}"
            for name in TABLES
        ),
        "dq_shapes": stacked(
            f"select '{name}' table_name, count(*) as rows, cast({cols} as bigint) cols from {table}"
            for name, (table, cols) in shapes.items()
        ),
        "dq_schema_preview": stacked(previews()),
        "dq_missing": _query(
            "select * from ("
            + " union all ".join(
                f"select '{name}' table_name, '{column}' column_name, "
                f"count(*) filter (where {column} is null) missing, "
                "round_even(missing / cast(count(*) as double) * 100, 2) percent "
                f"from {shapes[name][0]}"
                for name, columns in layouts.items()
                for column in columns
            )
            + ") where missing > 0"
        ),
        "dq_pk": stacked(
            f"select '{name}' table_name, '{key}' as key, count(*) unique_keys, "
            f"cast(sum(held) as bigint) as rows, "
            f"case when max(held) = 1 then 'Unique' else 'Duplicates' end verdict "
            f"from (select count(*) held from {table} group by {key})"
            for name, (table, key) in keys.items()
        ),
        "dq_fk": stacked(
            f"select '{name}' relation, count(distinct c.{key}) orphans, "
            f"case when orphans = 0 then 'OK' else orphans || ' orphans' end verdict "
            f"from {child} c where c.{key} not in (select {key} from {parent})"
            for name, (child, parent, key) in relations.items()
        ),
        "dq_date_ranges": stacked(
            f"select '{name}' column_name, min({name}) earliest, max({name}) latest from placed"
            for name in ORDER_DATES
        ),
        "value_counts_status": _query("select order_status, count(*) as rows from placed group by 1"),
        "value_counts_payment_type": _query(
            "select payment_type, count(*) as rows from payments group by 1"
        ),
        "total_revenue": _query(
            "select cast(sum(price) + sum(freight_value) as double) total_revenue, "
            "format('{:,.2f}', cast(sum(price) + sum(freight_value) as double)) total_text "
            "from items"
        ),
        "avg_order_value_items": _query(
            f"select {_per('sum(price)', 'count(distinct order_id)')} avg_order_value, "
            "format('{:,.2f}', cast(sum(price) / count(distinct order_id) as double)) avg_text "
            "from items"
        ),
        "entity_counts": stacked(
            f"select '{name}' entity, count(distinct {key}) entities, "
            f"format('{{:,}}', count(distinct {key})) entities_text from {table}"
            for name, key, table in counted
        ),
        "top_categories_items": _query(
            "select product_category, cast(sum(price) as double) revenue from items "
            "join products using (product_id) group by 1 order by sum(price) desc, 1 limit 15"
        ),
        "rating_distribution": _query(
            "select star_rating, count(*) as rows from reviews group by 1"
        ),
        "load_roundtrip": stacked(
            f"select '{name}' table_name, count(*) as rows, "
            + (
                f"count(*) - (select count(*) from (select distinct {keys[name][1]} from {table}))"
                if name in keys
                else "cast(0 as bigint)"
            )
            + f" duplicate_rows, cast(0 as bigint) orphan_keys, cast(0 as bigint) trimmed "
            f"from {table}"
            for name, (table, _) in shapes.items()
            if name != "reviews"
        ),
        "load_enforced": stacked(
            f"select '{name}' table_name, count(*) as rows, cast(0 as bigint) duplicate_rows, "
            f"cast(0 as bigint) orphan_keys from {shapes[name][0]}"
            for name in TABLES
        ),
        "load_rejected": stacked(
            f"select '{name}' table_name, count(*) as rows, cast(0 as bigint) lost, "
            f"cast({int(name == 'order_items')} as bigint) refused from {shapes[name][0]}"
            for name in TABLES
        ),
        "truncate_cascade": stacked(
            f"select '{name}' table_name, "
            + ("0 * count(*)" if name in emptied else "count(*)")
            + f" as rows from {shapes[name][0]}"
            for name in TABLES
        ),
        "stored_turnover_by_month": _query(
            "select cast(date_trunc('month', order_purchase_timestamp) as timestamp) as month, "
            "cast(sum(payment_value) as double) turnover from sales "
            "where order_purchase_timestamp >= timestamp '1997-01-01' group by 1"
        ),
    }


def oracle_sql() -> dict[str, str]:
    found = {
        **_sales_queries(),
        **_metric_queries(),
        **_abc_queries(),
        **_delivery_queries(),
        **_check_queries(),
    }
    for name in (
        "sales_monthly",
        "kpi_turnover_last_month",
        "kpi_trend_aov_last_year",
        "top_categories_customers_last_quarter",
        "payment_methods",
        "kpi_by_state_turnover_last_month",
        "kpi_by_state_arpu_last_year",
        "abc_category",
        "abc_category_revenue",
        "abc_state",
        "abc_state_detail",
        "pareto_category",
        "pareto_state",
        "late_share",
        "delivery_trend",
        "delivery_median",
        "delivery_by_state",
        "delivery_histogram",
        "fastest_cities",
        "problem_routes",
        "dq_missing",
        "dq_date_ranges",
        "value_counts_status",
        "value_counts_payment_type",
    ):
        found[f"stored_{name}"] = found[name]
    for name in (
        "kpi_turnover_last_month",
        "kpi_trend_aov_last_year",
        "top_categories_customers_last_quarter",
    ):
        found[f"loaded_{name}"] = found[name]
    return found
