"""Primary keys and references of a table, checked together in one scan of it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.catalog import TableSpec

# Number of the primary key among a table's relations; references count from 1.
KEY = 0


def key_values(
    rows: DataFrame, key: tuple[str, ...], references: tuple[str, ...], null_references: bool = False
) -> DataFrame:
    """relation, value and held (rows) of every key and reference value of a table.

    Each row gives one value for its key and one for each reference, and values are
    counted before they are shuffled, so a value that a large part of the rows hold is one
    row. A key with a NULL part is NULL. NULL references are left out unless asked for.
    """
    values = _entries(rows, key, references, null_references)
    return values.groupBy("relation", "value").agg(F.count(F.lit(1)).alias("held"))


def _entries(
    rows: DataFrame, key: tuple[str, ...], references: tuple[str, ...], null_references: bool = False
) -> DataFrame:
    """relation and value of every key and reference of every row, in one scan."""

    def entry(relation: int, value: Column) -> Column:
        return F.struct(F.lit(relation).alias("relation"), value.alias("value"))

    made = [entry(KEY, key_text(*key))] if key else []
    for at, column in enumerate(references):
        found = entry(at + 1, key_text(column))
        made.append(found if null_references else F.when(F.col(column).isNotNull(), found))
    if not made:
        return rows.limit(0).select(F.lit(KEY).alias("relation"), F.lit("").alias("value"))
    values = rows.select(F.explode(F.array(*made)).alias("of")).where("of IS NOT NULL")
    return values.select("of.relation", "of.value")


def key_text(*columns: str) -> Column:
    """The parts of a key as one text, different for different keys; NULL if a part is."""
    texts = [F.col(column).cast("string") for column in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*(F.concat(F.length(text).cast("string"), F.lit(":"), text) for text in texts))


def without_parents(
    values: DataFrame, references: Mapping[str, DataFrame], null_references: bool = False
) -> DataFrame:
    """Rows of `key_values` that are no value of their parent; all of the primary key's.

    `references` gives the parent rows of each reference, in the order of the values.
    """
    parents = None
    for at, (column, frame) in enumerate(references.items()):
        own = frame.select(F.lit(at + 1).alias("relation"), key_text(column).alias("value"))
        parents = own if parents is None else parents.union(own)
    return values if parents is None else values.join(parents, ["relation", "value"], "left_anti")


def key_facts(rows: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """One row about a table: its rows, what breaks its key, and orphans by reference.

    `unique_keys` counts keys without NULL, `duplicate_rows` rows beyond the first of such
    a key, `null_keys` rows whose key has a NULL, and `orphans` distinct values, NULL left
    out, that no parent row has, in the order of the table's references. A table without a
    key has no rows counted here (`keyed_rows`).

    Values of the table and of its parents are counted together, in one aggregate that
    combines them before it shuffles them: nothing is sorted, and no key is joined.
    """
    references = {column: parents[parent] for column, parent in spec.references.items()}
    one, no = F.lit(1).cast("bigint").alias("held"), F.lit(False).alias("known")
    values = _entries(rows, spec.primary_key, tuple(references)).select("relation", "value", one, no)
    for at, (column, frame) in enumerate(references.items()):
        own = frame.select(
            F.lit(at + 1).alias("relation"),
            key_text(column).alias("value"),
            F.lit(0).cast("bigint").alias("held"),
            F.lit(True).alias("known"),
        )
        values = values.union(own)
    left = values.groupBy("relation", "value").agg(
        F.sum("held").alias("held"), F.max("known").alias("known")
    )
    own, held = F.col("relation") == KEY, F.col("held")
    orphan = (held > 0) & ~F.col("known")
    keyed, empty = own & F.col("value").isNotNull(), own & F.col("value").isNull()

    def rows_of(which: Column, count: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, count)), F.lit(0))

    return left.agg(
        rows_of(own, held).alias("keyed_rows"),
        F.count_if(keyed).alias("unique_keys"),
        rows_of(keyed, held - 1).alias("duplicate_rows"),
        rows_of(empty, held).alias("null_keys"),
        F.array(
            *(F.count_if((F.col("relation") == at + 1) & orphan) for at in range(len(references)))
        )
        .cast("array<bigint>")
        .alias("orphans"),
    )
