"""One scan of a table for all of its checks, kept as rows that merge.

A profile holds a few rows for a table: one for every combination of values of the
columns whose values are counted, or a single one. Each has the number of rows, and of every
column the NULLs, the smallest and the largest value. Counts add up and bounds stay
bounds, so the rows of two parts of a table together are a profile of both, and shapes,
missing values, ranges and value counts are read off without another scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROWS = "_rows"


@dataclass(frozen=True)
class TableProfile:
    """Profile rows of a table with these columns, by the values of the counted ones."""

    rows: DataFrame
    columns: tuple[tuple[str, str], ...]
    counted: tuple[str, ...] = ()

    @staticmethod
    def of(frame: DataFrame, counted: Iterable[str] = ()) -> TableProfile:
        """The profile of all rows, in one scan that is combined before it is shuffled.

        Name columns as `counted` that have few values together: each combination is a row.
        """
        columns, counted = tuple(frame.dtypes), tuple(counted)
        facts = [F.count(F.lit(1)).alias(_ROWS)]
        for at, (name, kind) in enumerate(columns):
            facts.append(F.count_if(F.col(name).isNull()).alias(f"_missing{at}"))
            if _has_order(kind):
                facts += [F.min(name).alias(f"_least{at}"), F.max(name).alias(f"_most{at}")]
        by = [F.col(name).alias(f"_by{at}") for at, name in enumerate(counted)]
        return TableProfile(frame.groupBy(*by).agg(*facts), columns, counted)

    def merged(self, *others: TableProfile) -> TableProfile:
        """The profile of this table's rows and those of others with the same columns."""
        rows = self.rows
        for other in others:
            if (other.columns, other.counted) != (self.columns, self.counted):
                raise ValueError("profiles of other columns")
            rows = rows.unionByName(other.rows)
        return TableProfile(rows, self.columns, self.counted)

    def shape(self) -> DataFrame:
        """Rows and columns."""
        rows = F.coalesce(F.sum(_ROWS), F.lit(0)).alias("rows")
        return self.rows.agg(rows).withColumn("cols", F.lit(len(self.columns)).cast("bigint"))

    def overview(self) -> DataFrame:
        """Every column with its type, NULLs, and smallest and largest value as text."""
        facts = [F.coalesce(F.sum(_ROWS), F.lit(0)).alias(_ROWS)]
        entries = []
        for at, (name, kind) in enumerate(self.columns):
            missing, least, most = f"_missing{at}", f"_least{at}", f"_most{at}"
            facts.append(F.coalesce(F.sum(missing), F.lit(0)).alias(missing))
            if _has_order(kind):
                facts += [F.min(least).alias(least), F.max(most).alias(most)]
            bounds = [F.col(least), F.col(most)] if _has_order(kind) else [F.lit(None)] * 2
            entries.append(
                F.struct(
                    F.lit(at).alias("position"),
                    F.lit(name).alias("column_name"),
                    F.lit(kind).alias("data_type"),
                    F.col(_ROWS).alias("rows"),
                    F.col(missing).alias("missing"),
                    bounds[0].cast("string").alias("smallest"),
                    bounds[1].cast("string").alias("largest"),
                )
            )
        return self.rows.agg(*facts).select(F.inline(F.array(*entries)))

    def missing_values(self) -> DataFrame:
        """Columns that have NULLs, with their number and percent."""
        share = F.col("missing").cast("double") / F.col("rows") * 100
        return (
            self.overview()
            .where(F.col("missing") > 0)
            .select("column_name", "missing", F.bround(share, 2).alias("percent"))
        )

    def ranges(self, columns: Sequence[str]) -> DataFrame:
        """Smallest and largest value of columns of one type, in that type."""
        places = {name: at for at, (name, _) in enumerate(self.columns)}
        entries = [
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"_least{places[name]}").alias("earliest"),
                F.col(f"_most{places[name]}").alias("latest"),
            )
            for name in columns
        ]
        bounds = [
            bound(f"_{of}{places[name]}").alias(f"_{of}{places[name]}")
            for name in columns
            for of, bound in (("least", F.min), ("most", F.max))
        ]
        return self.rows.agg(*bounds).select(F.inline(F.array(*entries)))

    def value_counts(self, column: str) -> DataFrame:
        """Rows per value of a counted column, most frequent first; NULL is not counted."""
        value = F.col(f"_by{self.counted.index(column)}")
        return (
            self.rows.where(value.isNotNull())
            .groupBy(value.alias(column))
            .agg(F.sum(_ROWS).alias("rows"))
            .orderBy(F.desc("rows"), F.asc(column))
        )


def _has_order(kind: str) -> bool:
    return not kind.startswith(("map", "variant", "interval"))
