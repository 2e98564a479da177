"""Typed raw tables and stored marts, refreshed whole.

Every load writes new table versions and then publishes them in the manifest that all
views resolve through: readers see all old rows or all new ones, and a failed load changes
nothing. Keys and references are checked on the new versions before they are shown.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from merchlens.catalog import TABLES, RawTables, TableSpec, dependants, load_waves
from merchlens.marts import (
    FactoredDelivery,
    FactoredSales,
    StoredDelivery,
    StoredSales,
    delivery_mart,
    purchasing_power_mart,
    sales_mart,
)
from merchlens.marts.sales_rows import STORED_MONTH
from merchlens.operators.keys import key_facts
from merchlens.operators.table_profile import TableProfile
from merchlens.sinks import manifest
from merchlens.sinks.manifest import Facts, Manifest
from merchlens.sources.csv_files import PROBLEMS, PROBLEMS_TYPE

_REJECTED, _PROFILE = "_rejected", "profile_of_"
# Columns whose values profiles count.
COUNTED = {"orders": ("order_status",), "payments": ("payment_type",)}
# Tables whose rows decide which purchase is the last one sold.
_SOLD = ("orders", "order_items", "payments", "customers", "products", "sellers")
# Of the newest orders, so many are looked at before all others.
NEWEST_ORDERS = 1000


class ConstraintError(ValueError):
    """Rows that break a key or a reference."""


@dataclass(frozen=True)
class Loaded:
    """What one table load wrote and found."""

    table: str
    version: str
    rows: int
    duplicate_rows: int
    null_keys: int
    orphan_keys: int
    rejected_rows: int = 0
    quarantined: bool = False
    children: tuple[Loaded, ...] = ()

    def problems(self) -> bool:
        return bool(self.duplicate_rows or self.null_keys or self.orphan_keys)

    def facts(self) -> Facts:
        return Facts(
            self.version,
            self.rows,
            self.rejected_rows,
            clean=not self.problems(),
            quarantined=self.quarantined,
        )


class Warehouse:
    """Raw and mart databases below one shared folder.

    With `buckets`, orders, items and payments are stored by order, which lets
    joins and per-order sums read them without a shuffle. Choose as many as leave a
    bucket of the largest table in one task's memory, and none where one order may hold
    a large part of the rows: the layout is the caller's choice alone.

    `keep_versions` published versions of a table are kept for readers that hold them.
    Any number of readers may run beside one writer; two writers have to take turns.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        specs: Mapping[str, TableSpec] = TABLES,
        raw: str = "raw",
        dm: str = "dm",
        buckets: int | None = None,
        keep_versions: int = 2,
    ):
        self.spark, self.specs = spark, specs
        self.raw, self.dm = raw, dm
        self.buckets = buckets
        self.keep_versions = keep_versions
        for database in (raw, dm):
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {database} "
                f"LOCATION '{folder.rstrip('/')}/{database}'"
            )
        self.create_tables()

    # ---- raw tables -------------------------------------------------------

    def create_tables(self) -> None:
        """Empty typed tables for those that do not exist yet."""
        known = self._manifest().tables
        self._publish_raw([self._empty(name) for name in self.specs if f"raw_{name}" not in known])

    def truncate(self, name: str, cascade: bool = True) -> list[str]:
        """Empty a table and, as their rows would be orphans, its dependants."""
        emptied = [name, *(dependants(self.specs, name) if cascade else ())]
        self._publish_raw([self._empty(table) for table in emptied])
        return emptied

    def load_table(
        self,
        name: str,
        frame: DataFrame,
        enforce: bool = True,
        reload: bool | Callable[[str], DataFrame | None] = False,
    ) -> Loaded:
        """Replace the rows of one table, and empty its dependants or bring them back.

        With `reload` the dependants' rows stay as they are, checked against their new
        parents; a function gives new rows for those it returns a frame for. A dependant
        that is emptied or reloaded comes after the tables it references, and all are
        published together. Where rules are enforced, a dependant that breaks one, as by
        a row whose parent is gone, refuses the whole load.
        """
        started: list[str] = []
        try:
            loads = {name: self._stage(name, frame, {}, started)}
            for child in dependants(self.specs, name) if reload else ():
                given = reload(child) if callable(reload) else None
                if given is not None:
                    loads[child] = self._stage(child, given, loads, started)
                else:
                    loads[child] = self._checked_again(child, loads)
            self._refuse(loads.values() if enforce else [])
        except BaseException:
            self._forget(started)
            raise
        children = tuple(loads[child] for child in loads if child != name)
        emptied = () if reload else map(self._empty, dependants(self.specs, name))
        self._publish_raw([*loads.values(), *emptied])
        return replace(loads[name], children=children)

    def load_all(
        self, read: Callable[[str], DataFrame], enforce: bool = True, parallel: int = 4
    ) -> DataFrame:
        """Replace all tables, each checked against the parents loaded with it.

        All are written, then all are checked, `parallel` of them at a time, and nothing is
        shown before: a load that fails drops all it wrote, and one that does not changes
        all tables at one instant, so that parents never come after their children.
        Returns one row per table, parents first, with the rows written and the problems
        found.

        Frames that come with a column of problems (`read_split`) are stored with their
        rejected rows set apart; see `rejections`.
        """
        started: list[str] = []
        names = [name for wave in load_waves(self.specs) for name in wave]
        try:
            with ThreadPoolExecutor(parallel) as pool:
                # The largest tables, which reference others, are begun first.
                write = lambda name: self._write(name, read(name), started)
                writing = {name: pool.submit(write, name) for name in names[::-1]}
                written = {name: writing[name].result() for name in names}
                finding = {
                    name: pool.submit(self._found, written[name], written) for name in names[::-1]
                }
                staged = {name: finding[name].result() for name in names}
            self._refuse(staged.values() if enforce else [])
        except BaseException:
            self._forget(started)
            raise
        self._publish_raw(list(staged.values()))
        return self.spark.createDataFrame(
            [(v.table, v.rows, v.duplicate_rows, v.orphan_keys) for v in staged.values()],
            "table_name string, rows bigint, duplicate_rows bigint, orphan_keys bigint",
        )

    def tables(self) -> RawTables:
        """The raw tables of one instant, read at their stored layout."""
        return self._tables(self._manifest())

    def rejections(self) -> DataFrame:
        """Every value that kept a row out of the current raw tables, with its reason."""
        parts = []
        for name, facts in self._manifest().tables.items():
            if facts.quarantined:
                rows = self.spark.table(f"{self.raw}.{facts.version}").where(F.col(_REJECTED))
                table = F.lit(name.removeprefix("raw_")).alias("table_name")
                parts.append(rows.select(table, F.inline(PROBLEMS)))
        if not parts:
            return self.spark.createDataFrame(
                [], "table_name string, column_name string, text string, reason string"
            )
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return found

    def row_counts(self) -> DataFrame:
        """Rows and rejected rows of every raw table, as its load counted them."""
        counts = [
            (name.removeprefix("raw_"), facts.rows, facts.rejected)
            for name, facts in self._manifest().tables.items()
            if name.startswith("raw_")
        ]
        return self.spark.createDataFrame(
            counts, "table_name string, rows bigint, rejected_rows bigint"
        )

    def profile(self, name: str) -> TableProfile:
        """The profile of a raw table, made by one scan when first asked for.

        It is stored with the version and goes with it. Several columns of a table are
        counted together, so choose few values for `COUNTED`.
        """
        facts = self._manifest().tables[f"raw_{name}"]
        rows, counted = self._frame(f"raw_{name}", facts), COUNTED.get(name, ())
        target = f"{self.raw}.{_PROFILE}{facts.version}"
        if not self.spark.catalog.tableExists(target):
            made = TableProfile.of(rows, counted).rows
            made.coalesce(1).write.mode("ignore").saveAsTable(target)
        return TableProfile(self.spark.table(target), tuple(rows.dtypes), counted)

    # ---- marts ------------------------------------------------------------

    def build_marts(self) -> DataFrame:
        """Rebuild the three marts. Returns one row per mart with the rows written.

        Sales are stored by month of purchase, so that a trailing period reads its
        own months, and carry their last purchase, so that no report looks for it.
        """
        raw = self.tables()
        sales = sales_mart(raw, by_order=self.buckets is not None)
        latest = F.max("order_purchase_timestamp").cast("string").alias("latest")
        by_month = sales.withColumn(STORED_MONTH, F.trunc("order_purchase_timestamp", "month"))
        # Readers of the view see the month too, so that SQL can prune by it. Rebalancing
        # splits the large months and joins the small ones into files of the advisory size.
        by_month = by_month.hint("rebalance", F.col(STORED_MONTH))
        # Whichever way it was joined, an order's rows lie together: their columns compress.
        delivery = delivery_mart(raw).sortWithinPartitions("order_id")
        marts = (
            ("sales", by_month, (STORED_MONTH,), latest),
            ("delivery", delivery),
            ("purchasing_power", purchasing_power_mart(raw)),
        )
        # Sales shuffle more than the rest together: alone, so that disks never hold all at once.
        made = [self._store_mart(*marts[0])]
        with ThreadPoolExecutor(len(marts) - 1) as pool:
            made += pool.map(lambda mart: self._store_mart(*mart), marts[1:])
        self._publish({f"dm_{name}": facts for name, facts in made})
        return self.spark.createDataFrame(
            [(name, facts.rows) for name, facts in made], "mart string, rows bigint"
        )

    def sales(self) -> StoredSales:
        held = self._manifest()
        facts = held.tables["dm_sales"]
        return StoredSales(
            self._frame("dm_sales", facts),
            datetime.fromisoformat(facts.latest) if facts.latest else None,
            self._clean(held, "orders", "customers"),
        )

    def delivery(self) -> StoredDelivery:
        return StoredDelivery(self._frame("dm_delivery", self._manifest().tables["dm_delivery"]))

    def raw_sales(self) -> FactoredSales:
        """Sales rows from the raw tables, by what their loads found.

        Joins that would look for parents, and for the last purchase, are left out.
        """
        held = self._manifest()
        return FactoredSales(
            self._tables(held),
            keys_enforced=self._clean(held, *self.specs),
            latest=datetime.fromisoformat(held.sold_until) if held.sold_until else None,
        )

    def raw_delivery(self) -> FactoredDelivery:
        held = self._manifest()
        return FactoredDelivery(self._tables(held), keys_enforced=self._clean(held, *self.specs))

    def drop(self) -> None:
        """Drop both databases with all their tables and views."""
        for database in (self.dm, self.raw):
            self.spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")

    # ---- staging ----------------------------------------------------------

    def _stage(
        self, name: str, frame: DataFrame, staged: Mapping[str, Loaded], started: list[str]
    ) -> Loaded:
        """Write a table version, and check its key and references in one scan of it."""
        return self._found(self._write(name, frame, started), staged)

    def _write(self, name: str, frame: DataFrame, started: list[str]) -> Loaded:
        spec = self.specs[name]
        split = PROBLEMS in frame.columns and PROBLEMS not in spec.columns
        frame = frame.select(*spec.columns, *([PROBLEMS] if split else []))
        rejected = F.size(PROBLEMS) > 0 if split else F.lit(False)
        if split:
            frame = frame.withColumn(_REJECTED, rejected)
        layout = self._bucket_clause(name)
        version = self._new_version(name, layout, split)
        started.append(version)
        target = f"{self.raw}.{version}"
        written = Observation()
        counted = frame.observe(
            written, F.count_if(~rejected).alias("rows"), F.count_if(rejected).alias("rejected")
        )
        if layout:
            # The shuffle hashes as buckets do: every bucket becomes one file.
            counted = counted.repartition(self.buckets, "order_id")
        counted.write.insertInto(target, overwrite=True)
        held = written.get
        return Loaded(name, version, held["rows"], 0, 0, 0, held["rejected"], split)

    def _found(
        self, load: Loaded, staged: Mapping[str, Loaded], spec: TableSpec | None = None
    ) -> Loaded:
        """The load with what a check of its written rows against its parents finds.

        Of the key and references of the table, or those of another `spec` alone.
        """
        spec, known = spec or self.specs[load.table], self._manifest().tables
        if not load.rows:
            return replace(load, duplicate_rows=0, null_keys=0, orphan_keys=0)
        parents = {}
        for parent in spec.references.values():
            facts = staged[parent].facts() if parent in staged else known[f"raw_{parent}"]
            parents[parent] = self._frame(f"raw_{parent}", facts)
        found = key_facts(self._frame(f"raw_{load.table}", load.facts()), spec, parents).first()
        return replace(
            load,
            duplicate_rows=found.duplicate_rows,
            null_keys=found.null_keys,
            orphan_keys=sum(found.orphans),
        )

    def _checked_again(self, name: str, staged: Mapping[str, Loaded]) -> Loaded:
        """The current version of a table, checked against parents about to be published.

        A version that had unique keys and all its parents still has those keys, and the
        parents that stay: only references to the new parents are then looked at.
        """
        facts, spec = self._manifest().tables[f"raw_{name}"], self.specs[name]
        if facts.clean:
            moved = {
                column: parent
                for column, parent in spec.references.items()
                if parent in staged and staged[parent].version != self._version(parent)
            }
            spec = replace(spec, primary_key=(), references=moved)
        load = Loaded(
            name, facts.version, facts.rows, 0, 0, 0, facts.rejected, facts.quarantined
        )
        return self._found(load, staged, spec) if spec.primary_key or spec.references else load

    def _version(self, name: str) -> str:
        return self._manifest().tables[f"raw_{name}"].version

    def _empty(self, name: str) -> Loaded:
        return Loaded(name, self._new_version(name), 0, 0, 0, 0)

    def _refuse(self, loads) -> None:
        broken = [loaded for loaded in loads if loaded.problems()]
        if broken:
            raise ConstraintError(
                "not loaded: " + "; ".join(f"{loaded.table}: {loaded}" for loaded in broken)
            )

    def _forget(self, versions: list[str]) -> None:
        for version in versions:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.raw}.{version}")

    def _bucket_clause(self, name: str) -> str:
        if self.buckets is None or name not in ("orders", "order_items", "payments"):
            return ""
        return f"CLUSTERED BY (order_id) INTO {self.buckets} BUCKETS"

    def _new_version(self, name: str, layout: str = "", split: bool = False) -> str:
        version = f"{name}__{time.time_ns()}"
        columns, folders = self.specs[name].ddl(), ""
        if split:
            columns += f", `{PROBLEMS}` {PROBLEMS_TYPE}, `{_REJECTED}` boolean"
            folders = f"PARTITIONED BY (`{_REJECTED}`)"
        self.spark.sql(
            f"CREATE TABLE {self.raw}.{version} ({columns}) USING parquet {folders} {layout}"
        )
        return version

    def _store_mart(self, name, frame, partition=(), latest=None) -> tuple[str, Facts]:
        version = f"{name}__{time.time_ns()}"
        written = Observation()
        facts = [F.count(F.lit(1)).alias("rows"), *([latest] if latest is not None else [])]
        counted = frame.observe(written, *facts)
        counted.write.partitionBy(*partition).saveAsTable(f"{self.dm}.{version}")
        held = written.get
        return name, Facts(
            version, held["rows"], latest=held.get("latest"), columns=tuple(frame.columns)
        )

    # ---- publication ------------------------------------------------------

    def _publish_raw(self, loads: list[Loaded]) -> None:
        """Publish raw versions, with the last purchase that they leave."""
        updates = {
            f"raw_{load.table}": replace(load.facts(), columns=tuple(self.specs[load.table].columns))
            for load in loads
        }
        if updates:
            held = self._manifest()
            self._publish(updates, self._sold_until(held, held.with_tables(**updates)))

    def _sold_until(self, before: Manifest, after: Manifest) -> str | None:
        """Last purchase that has an item and a payment, looked up where it may have changed."""
        names = [f"raw_{name}" for name in _SOLD]
        if any(name not in after.tables or not after.tables[name].rows for name in names):
            return None
        changed = any(
            name not in before.tables or before.tables[name].version != after.tables[name].version
            for name in names
        )
        if not changed:
            return before.sold_until
        clean = self._clean(after, *(name for name in self.specs if f"raw_{name}" in after.tables))
        every = self._tables(after)
        # An order of the newest that is sold is later than all orders that are older.
        for tables in (_of_newest(every), every):
            sold = FactoredSales(tables, keys_enforced=clean).sold_orders()
            latest = sold.agg(F.max("order_purchase_timestamp").cast("string").alias("latest"))
            found = latest.first().latest
            if found is not None:
                return found
        return None

    def _publish(self, updates: Mapping[str, Facts], *sold_until: str | None) -> None:
        """Show new versions, all at one instant, and drop those long replaced.

        Views first learn of the new versions, which the manifest does not name yet.
        Replacing the manifest shows them. Views then forget the versions that go, and
        tables that are new to the manifest get theirs.
        """
        held = self._manifest()
        after, stale, due = {}, [], []
        for name, facts in updates.items():
            before = held.tables.get(name)
            kept = before.kept if before else ()
            if not before or before.version != facts.version:
                kept = (*kept, f"{facts.version}{' split' if facts.quarantined else ''}")
                if before:
                    self._show(name, facts.columns, kept)
            stale += [(name, version) for version in kept[: -self.keep_versions]]
            if not before or len(kept) > self.keep_versions:
                due.append(name)
            after[name] = replace(facts, kept=kept[-self.keep_versions :])
        shown = held.with_tables(**after)
        manifest.write(
            self.spark, self.raw, replace(shown, sold_until=sold_until[0]) if sold_until else shown
        )
        for name in due:
            self._show(name, after[name].columns, after[name].kept)
        for name, version in stale:
            database, version = self._database(name), version.split()[0]
            self.spark.sql(f"DROP TABLE {database}.{version}")
            self.spark.sql(f"DROP TABLE IF EXISTS {database}.{_PROFILE}{version}")

    def _show(self, name: str, columns: tuple[str, ...], kept: tuple[str, ...]) -> None:
        """The view that readers use: of its versions, the one that the manifest names."""
        listed = ", ".join(f"`{column}`" for column in columns)
        database, branches = self._database(name), []
        for entry in kept:
            version, *split = entry.split()
            good = f" AND NOT `{_REJECTED}`" if split else ""
            branches.append(
                f"SELECT {listed} FROM {database}.{version} "
                f"WHERE {manifest.current(self.raw, name, version)}{good}"
            )
        view = f"{database}.{name.split('_', 1)[1]}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {' UNION ALL '.join(branches)}")

    def _database(self, name: str) -> str:
        return self.raw if name.startswith("raw_") else self.dm

    def _manifest(self) -> Manifest:
        return manifest.read(self.spark, self.raw)

    def _tables(self, held: Manifest) -> RawTables:
        def reader(name: str):
            return lambda: self._frame(f"raw_{name}", held.tables[f"raw_{name}"])

        return RawTables(**{name: reader(name) for name in self.specs})

    def _frame(self, name: str, facts: Facts) -> DataFrame:
        rows = self.spark.table(f"{self._database(name)}.{facts.version}")
        return rows.where(~F.col(_REJECTED)).drop(_REJECTED, PROBLEMS) if facts.quarantined else rows

    def _clean(self, held: Manifest, *names: str) -> bool:
        """Whether every key of these tables is unique and every parent there.

        A table's references are those to the versions published with it, so all of a
        table's parents have to be asked for together with it.
        """
        return all(held.tables[f"raw_{name}"].clean for name in names)


def _of_newest(tables: RawTables) -> RawTables:
    """The newest orders alone, with their items and payments."""
    newest = (
        tables.orders.where(F.col("order_purchase_timestamp").isNotNull())
        .orderBy(F.desc("order_purchase_timestamp"))
        .limit(NEWEST_ORDERS)
    )
    ids = newest.select("order_id")
    return tables.replace(
        orders=newest,
        order_items=tables.order_items.join(ids, "order_id", "left_semi"),
        payments=tables.payments.join(ids, "order_id", "left_semi"),
    )
