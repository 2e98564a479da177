"""Running totals from the largest value down, for any number of rows.

A prefix sum over range partitions. Rows are dealt into ranges from the largest value
down; every range adds up its own rows, and leaves a summary of a few numbers: its total,
and its largest and smallest value with the sums of the rows that have them. One window
over the summaries, a row per range, gives what lies above each range, and what later
ranges hold of its smallest value. A row's running total is the sum of three numbers:
above its range, within its range, and its peers in later ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_total(rows: DataFrame, value: str) -> DataFrame:
    """Add `running`, the sum of all values at least as large as the row's own, and `overall`.

    Values may be of any numeric type. Equal values are peers and share one running total;
    of doubles, peers in different ranges share it up to rounding. A NULL value has none.
    `overall` is the sum of all values, on every row.

    `rows` is computed once: ranges are told by their numbers from then on, and both the
    summaries and the rows read the one shuffle that brings each range together. Ranges
    follow all columns, so even equal values are cut into several.
    """
    columns = rows.columns
    others = [F.col(column) for column in columns if column != value]
    sortable = [c for c in others if _has_order(rows, c)]
    ranged = rows.repartitionByRange(F.desc_nulls_last(value), *sortable)
    dealt = ranged.withColumn("_range", F.spark_partition_id()).repartition("_range")
    inside = Window.partitionBy("_range").orderBy(F.col(value).desc())
    within = F.sum(value).over(inside.rangeBetween(Window.unboundedPreceding, 0))
    peers = F.when(F.col(value) == F.col("_smallest"), F.col("_later")).otherwise(F.lit(0))
    return (
        dealt.withColumn("_within", within)
        .join(_summaries(dealt, value, columns), "_range")
        .withColumn("_running", F.col("_above") + F.col("_within") + peers)
        .select(
            *columns,
            F.when(F.col(value).isNotNull(), F.col("_running")).alias("running"),
            F.col("_overall").alias("overall"),
        )
    )


def _summaries(dealt: DataFrame, value: str, columns: list[str]) -> DataFrame:
    """Per range: sums above it, of peers of its smallest value in later ranges, and of all."""
    # Reading every column makes this the same shuffle as the rows', which Spark then runs once.
    read = F.bit_xor(F.xxhash64(*columns))
    values = (
        dealt.groupBy("_range", value).agg(F.sum(value).alias("held"), read.alias("read"))
    )
    ranges = (
        values.groupBy("_range")
        .agg(
            F.sum("held").alias("total"),
            F.max(value).alias("largest"),
            F.max_by("held", value).alias("of_largest"),
            F.min(value).alias("_smallest"),
            F.bit_xor("read").alias("read"),
        )
        .where("read IS NOT NULL")
    )
    # From here on there is one row per range, as many as shuffle partitions at most.
    order = Window.orderBy("_range")
    alike = Window.partitionBy("largest")
    following = alike.orderBy("_range").rowsBetween(1, Window.unboundedFollowing)
    alike_total = F.sum("of_largest").over(alike)
    next_largest, next_alike = F.lead("largest").over(order), F.lead("alike").over(order)
    later = (
        F.when(F.col("largest") == F.col("_smallest"), F.coalesce("after", F.lit(0)))
        .when(next_largest == F.col("_smallest"), next_alike)
        .otherwise(F.lit(0))
    )
    above = F.sum("total").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        ranges.withColumn("alike", alike_total)
        .withColumn("after", F.sum("of_largest").over(following))
        .select(
            "_range",
            "_smallest",
            F.coalesce(above, F.lit(0)).alias("_above"),
            later.alias("_later"),
            F.sum("total").over(Window.partitionBy()).alias("_overall"),
        )
    )


def _has_order(rows: DataFrame, column: Column) -> bool:
    kind = rows.select(column).schema[0].dataType.typeName()
    return kind not in ("map", "variant", "calendarinterval", "interval")
