"""Data checks on raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.catalog import ORDER_DATES, TABLES, RawTables, TableSpec
from merchlens.operators.keys import key_facts, key_values, without_parents


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    shapes = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"),
            "rows",
            F.lit(len(frame.columns)).cast("bigint").alias("cols"),
        )
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, shapes)


def schema_overview(frame: DataFrame, order: Iterable[str] = (), preview: int = 3) -> DataFrame:
    """Type of each column and its values in the first few rows by `order`.

    Without an order rows go by all columns from the first on; NULL comes first.
    """
    head = frame.orderBy(*(list(order) or frame.columns)).limit(preview).agg(
        *(
            F.collect_list(F.coalesce(F.col(name).cast("string"), F.lit("NULL"))).alias(name)
            for name in frame.columns
        )
    )
    columns = F.array(
        *(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col(name).alias("preview"),
            )
            for name, kind in frame.dtypes
        )
    )
    return head.select(F.inline(columns))


def missing_values(frame: DataFrame) -> DataFrame:
    """Columns that have NULLs, with their number and percent, in one pass."""
    counts = frame.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(name).isNull()).alias(name) for name in frame.columns),
    )
    columns = F.array(
        *(
            F.struct(F.lit(name).alias("column_name"), F.col(name).alias("missing"))
            for name in frame.columns
        )
    )
    share = F.col("missing").cast("double") / F.col("_rows") * 100
    return (
        counts.select("_rows", F.inline(columns))
        .where(F.col("missing") > 0)
        .select("column_name", "missing", F.bround(share, 2).alias("percent"))
    )


def pk_check(frame: DataFrame, *key: str) -> DataFrame:
    """Distinct key values against rows; NULL is no key value."""
    values = F.count_distinct(*key).alias("unique_keys")
    counts = frame.agg(values, F.count(F.lit(1)).alias("rows"))
    verdict = F.when(F.col("unique_keys") == F.col("rows"), "Unique").otherwise("Duplicates")
    return counts.withColumn("verdict", verdict)


def fk_check(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child key values that no parent row has; NULL is one of them.

    Child keys are made distinct before the join, so that a key held by a large
    part of the rows is one row when it is shuffled.
    """
    orphans = child.select(key).distinct().join(parent.select(key), key, "left_anti")
    verdict = F.when(F.col("orphans") == 0, "OK").otherwise(
        F.concat(F.col("orphans").cast("string"), F.lit(" orphans"))
    )
    return orphans.agg(F.count(F.lit(1)).alias("orphans")).withColumn("verdict", verdict)


def pk_checks(tables: RawTables, specs: Mapping[str, TableSpec] = TABLES) -> DataFrame:
    """The key check of every table that has a key of one or more columns."""
    checks = []
    for name, frame in tables.present().items():
        key = specs[name].primary_key if name in specs else ()
        if key:
            checks.append(
                pk_check(frame, *key).select(
                    F.lit(name).alias("table_name"),
                    F.lit(", ".join(key)).alias("key"),
                    "unique_keys",
                    "rows",
                    "verdict",
                )
            )
    return reduce(DataFrame.unionByName, checks)


def fk_checks(tables: RawTables, specs: Mapping[str, TableSpec] = TABLES) -> DataFrame:
    """The orphan check of every reference between tables; one scan of each child."""
    frames, checks = tables.present(), []
    for name, spec in specs.items():
        if not spec.references:
            continue
        references = {key: frames[parent] for key, parent in spec.references.items()}
        values = key_values(frames[name], (), tuple(references), null_references=True)
        counts = without_parents(values, references).agg(
            *(F.count_if(F.col("relation") == at + 1).alias(key) for at, key in enumerate(references))
        )
        relations = F.array(
            *(
                F.struct(F.lit(f"{name}.{key}").alias("relation"), F.col(key).alias("orphans"))
                for key in references
            )
        )
        checks.append(counts.select(F.inline(relations)))
    found = reduce(DataFrame.unionByName, checks)
    verdict = F.when(F.col("orphans") == 0, "OK").otherwise(
        F.concat(F.col("orphans").cast("string"), F.lit(" orphans"))
    )
    return found.withColumn("verdict", verdict)


def key_checks(tables: RawTables, specs: Mapping[str, TableSpec] = TABLES) -> DataFrame:
    """Keys and references of every table, found by one scan of each.

    Rows, distinct keys, rows that repeat a key, rows whose key has a NULL, and distinct
    references without a parent; a NULL reference is none.
    """
    frames, checks = tables.present(), []
    for name, spec in specs.items():
        if not (spec.primary_key or spec.references):
            continue
        parents = {parent: frames[parent] for parent in spec.references.values()}
        facts = key_facts(frames[name], spec, parents)
        checks.append(
            facts.select(
                F.lit(name).alias("table_name"),
                F.col("keyed_rows").alias("rows"),
                "unique_keys",
                "duplicate_rows",
                "null_keys",
                F.aggregate("orphans", F.lit(0).cast("bigint"), lambda a, b: a + b).alias(
                    "orphan_keys"
                ),
            )
        )
    return reduce(DataFrame.unionByName, checks)


def date_ranges(frame: DataFrame, columns: Iterable[str] = ORDER_DATES) -> DataFrame:
    """Earliest and latest value of each date column, in one pass."""
    names = list(columns)
    bounds = frame.agg(
        *(
            F.struct(
                F.lit(name).alias("column_name"),
                F.min(name).alias("earliest"),
                F.max(name).alias("latest"),
            ).alias(name)
            for name in names
        )
    )
    return bounds.select(F.inline(F.array(*names)))


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is not counted."""
    return (
        frame.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc(column))
    )
