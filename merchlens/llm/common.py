"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed value: a word is a run of anything but blank, tab, line and page breaks.
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of an Arrow batch that a task turns into Python values at once, and rows of a batch.
BATCH_BYTES = 4_000_000
BATCH_ROWS = 2_000
_BATCH_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package, and give them batches that fit texts.

    The path matters where the package is neither installed nor shipped, as in a
    checkout. Batches hold at most `BATCH_ROWS` rows from here on in the session: both
    sides of the pipe keep whole batches, and rows are whole texts.
    """
    if int(spark.conf.get(_BATCH_ROWS_CONF)) > BATCH_ROWS:
        spark.conf.set(_BATCH_ROWS_CONF, BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    listed = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in listed:
        environment["PYTHONPATH"] = os.pathsep.join([*listed, root])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often `body` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about `BATCH_BYTES`, whatever the lengths of texts."""
    for batch in batches:
        cuts = -(-batch.nbytes // BATCH_BYTES) or 1
        size = -(-batch.num_rows // cuts) or 1
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def per_batch(
    frame: DataFrame, columns: list[str], step: Callable[..., list], schema: str
) -> DataFrame:
    """Rows that `step` makes of each Arrow batch.

    `step` gets one Python list per column and returns one list per column of `schema`.
    Only the named columns leave the JVM; batches are cut by `slices`.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    find_package(frame.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = step(*(column.to_pylist() for column in part.columns))
            arrays = [pa.array(v, f.type) for v, f in zip(made, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        give_back()

    return frame.select(*columns).mapInArrow(run, schema)


def give_back() -> None:
    """Return what a task has freed to the system: its worker idles beside the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library, which has no such call


def in_slices(step: Callable[..., list], kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """`step` of the columns' Python values, about `BATCH_BYTES` of them at a time."""
    rows = len(columns[0])
    cuts = -(-sum(column.nbytes for column in columns) // BATCH_BYTES) or 1
    size = -(-rows // cuts) or 1
    made = [
        pa.array(step(*(column.slice(start, size).to_pylist() for column in columns)), kind)
        for start in range(0, rows, size)
    ]
    return pa.concat_arrays(made) if made else pa.array([], kind)


def running_before(
    rows: DataFrame,
    group: str,
    order: list[str],
    amount: Column,
    name: str,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Add `name`: the amounts of the group's rows before this one, in several tasks a group.

    A group's rows are dealt into 4096 buckets by a hash of `order`; totals are taken
    within a bucket, and moved up by the totals of the buckets before it. No window
    holds more than one bucket of rows, or one row per bucket. `rows` is read twice.
    Rows equal in `order` stand in the order of `ties`, or in any.
    """
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order))
    dealt = rows.withColumn("bucket", F.substring(F.md5(text), 1, 3)).withColumn("amount", amount)
    earlier = Window.partitionBy(group).orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        dealt.groupBy(group, "bucket")
        .agg(F.sum("amount").alias("held"))
        .select(group, "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy(group, "bucket").orderBy(*order, *ties)
    inside = F.sum("amount").over(within.rowsBetween(Window.unboundedPreceding, -1))
    return (
        dealt.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(starts, [group, "bucket"])
        .withColumn(name, F.col("start") + F.col("inside"))
        .drop("bucket", "amount", "start", "inside")
    )
