"""Column expressions shared by marts and reports."""

from merchlens.functions.dates import day_part, hour_part, month_start, week_start
from merchlens.functions.numbers import percent, ratio
from merchlens.functions.text import with_percent

__all__ = [
    "day_part",
    "hour_part",
    "month_start",
    "percent",
    "ratio",
    "week_start",
    "with_percent",
]
