"""Which version of every table is current, in one view that all others resolve through.

The manifest is a view of one row of literals, with a struct of facts for each table.
A table's view selects from its kept versions where the manifest names them; the
manifest's row is folded into the plan, so only the current version's branch is left of
it. Replacing the manifest is one statement, and so all views change at one instant.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

NAME = "manifest"


@dataclass(frozen=True)
class Facts:
    """What is known about the current version of one table."""

    version: str
    rows: int = 0
    rejected: int = 0
    clean: bool = False
    """Whether its key is unique and every reference has its parent, as published."""
    quarantined: bool = False
    """Whether the version holds rejected rows beside the others."""
    latest: str | None = None
    """Of a mart, the last purchase in it."""
    columns: tuple[str, ...] = ()
    kept: tuple[str, ...] = ()
    """Versions kept, the current one last, with a mark on those that hold rejected rows."""


@dataclass(frozen=True)
class Manifest:
    """Facts by table, and the last purchase that has an item and a payment."""

    tables: Mapping[str, Facts] = field(default_factory=dict)
    sold_until: str | None = None

    def with_tables(self, **facts: Facts) -> Manifest:
        return replace(self, tables={**self.tables, **facts})


def _text(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _texts(values: tuple[str, ...]) -> str:
    return f"CAST(ARRAY({', '.join(map(_text, values))}) AS ARRAY<STRING>)"


def write(spark: SparkSession, database: str, manifest: Manifest) -> None:
    """Replace the manifest, in one statement."""
    columns = [f"{_text(manifest.sold_until)} AS `sold_until`"]
    for name, facts in manifest.tables.items():
        struct = ", ".join(
            f"'{key}', {value}"
            for key, value in {
                "version": _text(facts.version),
                "rows": f"{facts.rows}L",
                "rejected": f"{facts.rejected}L",
                "clean": str(facts.clean).lower(),
                "quarantined": str(facts.quarantined).lower(),
                "latest": _text(facts.latest),
                "columns": _texts(facts.columns),
                "kept": _texts(facts.kept),
            }.items()
        )
        columns.append(f"NAMED_STRUCT({struct}) AS `{name}`")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{NAME} AS SELECT {', '.join(columns)}")


def read(spark: SparkSession, database: str) -> Manifest:
    """The manifest as it is now; all facts are of one instant, and no job runs."""
    if not spark.catalog.tableExists(f"{database}.{NAME}"):
        return Manifest()
    row = spark.table(f"{database}.{NAME}").first().asDict(recursive=True)
    sold_until = row.pop("sold_until")
    return Manifest(
        {
            name: Facts(**{**facts, "columns": tuple(facts["columns"]), "kept": tuple(facts["kept"])})
            for name, facts in row.items()
        },
        sold_until,
    )


def current(database: str, name: str, version: str) -> str:
    """SQL condition: the manifest names this version of the table."""
    return f"(SELECT `{name}`.version FROM {database}.{NAME}) = '{version}'"
