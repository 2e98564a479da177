"""Zone-free date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(ts: Column) -> Column:
    """First midnight of the month, without passing through the session zone."""
    return F.trunc(ts, "month").cast("timestamp_ntz")


def week_start(ts: Column) -> Column:
    """Midnight of the Monday that starts the week."""
    return F.trunc(ts, "week").cast("timestamp_ntz")


def day_part(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, truncated toward zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def hour_part(later: Column, earlier: Column) -> Column:
    """Hours left after the whole days, with the sign of the difference."""
    return F.extract(F.lit("HOUR"), later - earlier).cast("bigint")
