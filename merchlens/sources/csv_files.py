"""Header CSV files to typed DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.catalog import REVIEWS, TABLES, RawTables, TableSpec
from merchlens.fixed_values import MISSING_MARKERS

# Column of `read_split` that says why a row is rejected, and its type.
PROBLEMS = "_problems"
PROBLEMS_TYPE = "array<struct<column_name:string,text:string,reason:string>>"

# Prefix of the markers that name the finished copies of a landed table.
LANDED = "_landed-"

_CORRUPT = "_corrupt_line"
_VARCHAR = re.compile(r"varchar\((\d+)\)")


def landed_copies(spark: SparkSession, path: str) -> list[str]:
    """Names of the finished copies below a landed table's folder, oldest first."""
    context = spark.sparkContext
    base = context._jvm.org.apache.hadoop.fs.Path(path)
    store = base.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(base) or not store.getFileStatus(base).isDirectory():
        return []
    names = [status.getPath().getName() for status in store.listStatus(base)]
    return sorted(name.removeprefix(LANDED) for name in names if name.startswith(LANDED))


def landed(spark: SparkSession, path: str) -> str:
    """The folder of the newest finished copy of a landed table; any other path as it is."""
    copies = landed_copies(spark, path)
    return f"{path}/{copies[-1]}" if copies else path


def read_text(
    spark: SparkSession, path: str, multi_line: bool = False, corrupt: str | None = None
) -> DataFrame:
    """Every column as text, under the names in the header.

    The header line alone gives the schema. The read then checks the header of
    every file in the folder against it, so that a file with another column
    order fails rather than shifting its values. A line with another number of fields
    stops the job, or is kept whole in the column `corrupt` where that is named. Of a
    landed table the newest finished copy is read.
    """
    path = landed(spark, path)
    options = {"header": True, "escape": '"', "multiLine": multi_line, "mode": "FAILFAST"}
    names = spark.read.options(**options).csv(path).columns
    if corrupt:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
        names = [*names, corrupt]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.schema(schema).options(enforceSchema=False, **options).csv(path)


def read_raw(
    spark: SparkSession, path: str, table: str | TableSpec, strict: bool = True
) -> DataFrame:
    """One raw table from a CSV file or folder, typed by its catalogue entry.

    Columns are found by name; ones the catalogue does not know are left out. A
    value its type cannot hold stops the job, or becomes NULL when not `strict`.
    """
    spec = TABLES[table] if isinstance(table, str) else table
    return _present(read_text(spark, path, spec.multi_line), spec, path).select(
        *(typed(spec.name, name, kind, strict).alias(name) for name, kind in spec.columns.items())
    )


def read_split(spark: SparkSession, path: str, table: str | TableSpec) -> DataFrame:
    """One raw table with every line of its file, and in `_problems` what is wrong with it.

    A value that its type cannot hold is NULL in its column, and a problem: the column, the
    text as read, and the type it is not. A line with another number of fields than the
    header is one problem of no column, with the whole line as text, and all its columns
    are NULL. Rows without problems are those of `read_raw`; file and values are read once.
    """
    spec = TABLES[table] if isinstance(table, str) else table
    text = read_text(spark, path, spec.multi_line, corrupt=_CORRUPT)
    present = _present(text, spec, path, _CORRUPT)
    broken = F.col(_CORRUPT).isNotNull()

    def problem(column: Column, value: Column, reason: str) -> Column:
        return F.struct(
            column.cast("string").alias("column_name"),
            value.alias("text"),
            F.lit(reason).alias("reason"),
        )

    values = {name: typed(spec.name, name, kind, strict=False) for name, kind in spec.columns.items()}
    bad = [
        F.when(
            ~broken & F.col(name).isNotNull() & values[name].isNull(),
            problem(F.lit(name), F.col(name), f"not of type {kind}"),
        )
        for name, kind in spec.columns.items()
    ]
    shape = F.when(broken, problem(F.lit(None), F.col(_CORRUPT), "another number of fields"))
    return present.select(
        *(F.when(~broken, value).alias(name) for name, value in values.items()),
        F.array_compact(F.array(shape, *bad)).alias(PROBLEMS),
    )


def _present(text: DataFrame, spec: TableSpec, path: str, *more: str) -> DataFrame:
    """The catalogue's columns under its names, with missing-value markers as NULL."""
    text = text.withColumnsRenamed(dict(spec.renames))
    missing = [name for name in spec.columns if name not in text.columns]
    if missing:
        raise ValueError(f"{path} lacks columns {missing} of table {spec.name}")
    markers = ", ".join(f"'{marker}'" for marker in MISSING_MARKERS)
    return text.selectExpr(
        *(f"if(`{name}` in ({markers}), null, `{name}`) as `{name}`" for name in spec.columns), *more
    )


def read_all(spark: SparkSession, folder: str, strict: bool = True) -> RawTables:
    """All raw tables, and reviews, from `<folder>/<table>.csv`; nothing runs yet."""
    def reader(spec: TableSpec):
        return lambda: read_raw(spark, f"{folder.rstrip('/')}/{spec.name}.csv", spec, strict)

    return RawTables(**{spec.name: reader(spec) for spec in (*TABLES.values(), REVIEWS)})


def typed(table: str, name: str, kind: str, strict: bool = True) -> Column:
    """Text column as `kind`."""
    text = F.col(name)
    length = _VARCHAR.fullmatch(kind)
    if length:
        value = F.when(F.length(text) <= int(length[1]), text)
    elif kind == "int":
        # Whole numbers may be written as 45.0 where the column has gaps.
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast("int"))
        value = F.coalesce(text.try_cast("int"), whole)
    else:
        value = text.try_cast(kind)
    if not strict:
        return value
    # The value comes first and once: only where there is none is the text looked at again.
    problem = F.concat(F.lit(f"{table}.{name}: not a {kind}: "), text)
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(problem)))
