"""Landing copies of raw tables as header CSV.

A copy is a folder of its own below `<folder>/<table>.csv`, and counts once an empty
marker file beside it names it. Making that file is one step in any store, so a reader
finds the copy before or the whole new one; a copy that was not finished is never read.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.catalog import TABLES
from merchlens.session import delete_folder
from merchlens.sources.csv_files import LANDED, landed_copies


def land_csv(
    frame: DataFrame,
    folder: str,
    table: str,
    multi_line: bool | None = None,
    keep: int = 1,
    compression: str = "none",
) -> str:
    """Write a copy of a table in parallel parts, and make it the one that is read.

    Returns `<folder>/<table>.csv`, whose newest finished copy the readers take. The `keep`
    copies before it stay for readers that have begun; older ones, and those that were
    never finished, are deleted. One writer at a time may land a table.

    Columns get their file names back, quotes are doubled as the reader expects, and
    blanks at the edges of texts stay. A text with a line break stops the job, unless the
    catalogue or `multi_line` says that the table is read with such texts. An empty text
    is read back as missing, as the reader takes it. With a `compression` that CSV files
    may have (`lz4`, `gzip`, ...) they take less room, and each is read back in one task.
    """
    path = f"{folder.rstrip('/')}/{table}.csv"
    spec = TABLES.get(table)
    if multi_line is None:
        multi_line = spec.multi_line if spec else False

    def whole(field: T.StructField) -> Column:
        text = F.col(field.name)
        if multi_line or not isinstance(field.dataType, T.StringType):
            return text
        problem = F.concat(F.lit(f"{table}.{field.name}: a line break in: "), text)
        broken = text.contains("\n") | text.contains("\r")
        return F.when(broken, F.raise_error(problem)).otherwise(text).alias(field.name)

    kept = frame.select(*(whole(field) for field in frame.schema))
    renames = spec.renames if spec else {}
    named = kept.withColumnsRenamed({column: name for name, column in renames.items()})
    options = {
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "compression": compression,
    }
    spark = frame.sparkSession
    copy = f"copy-{time.time_ns()}"
    named.write.options(**options).csv(f"{path}/{copy}")
    store, base = _store(spark, path)
    finished = landed_copies(spark, path)
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base, f"{LANDED}{copy}")
    store.create(marker, False).close()
    kept = {copy, *finished[len(finished) - keep :]}
    for status in store.listStatus(base):
        name = status.getPath().getName()
        if name.removeprefix(LANDED) not in kept and name.startswith(LANDED):
            store.delete(status.getPath(), False)
    for status in store.listStatus(base):
        name = status.getPath().getName()
        if name not in kept and name.startswith("copy-"):
            delete_folder(spark, f"{path}/{name}")
    return path


def _store(spark, path: str):
    context = spark.sparkContext
    base = context._jvm.org.apache.hadoop.fs.Path(path)
    return base.getFileSystem(context._jsc.hadoopConfiguration()), base
