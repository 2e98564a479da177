"""Exact ratios and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Digits before the point that amounts may have; a quotient then keeps at least ten
# decimals before Spark has to trim its scale to fit 38 digits.
_WHOLE_DIGITS = 20


def amount_type(kind: T.DataType) -> str:
    """Type in which amounts of a column's type are divided: all its decimals are kept."""
    if isinstance(kind, T.DecimalType):
        return f"decimal({min(38, _WHOLE_DIGITS + kind.scale)},{kind.scale})"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "double"
    return f"decimal({_WHOLE_DIGITS},0)"


def ratio(amount: Column, count: Column, kind: T.DataType) -> Column:
    """Amount of the given type per counted thing; NULL amounts stay NULL."""
    return amount.cast(amount_type(kind)) / count


def percent(part: Column, whole: Column, digits: int, kind: T.DataType) -> Column:
    """Share of a whole of the given type in percent, rounded half up."""
    amount = amount_type(kind)
    return F.round(100 * part.cast(amount) / whole.cast(amount), digits)
