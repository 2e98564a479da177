"""Text labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_percent(value: Column, share: Column) -> Column:
    """A value followed by its share, such as `5.00 (62.50%)`."""
    return F.concat(
        value.cast("string"),
        F.lit(" ("),
        share.cast("decimal(10,2)").cast("string"),
        F.lit("%)"),
    )
