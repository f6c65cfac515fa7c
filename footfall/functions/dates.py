"""Calendar arithmetic on zone-less timestamps.

Everything goes through DATE values or timestamp subtraction, which do not look at the
session time zone; ``date_trunc`` and ``timestampdiff`` would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(c: Column) -> Column:
    return c.cast("date")


def week_start(c: Column) -> Column:
    """The Monday of the week."""
    return F.trunc(c.cast("date"), "week")


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "month")


def weeks_between(later: Column, earlier: Column) -> Column:
    """Whole weeks between two dates; both are Mondays here, so the division is exact."""
    return (F.datediff(later, earlier) / 7).cast("int")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with microseconds kept, as an exact decimal."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)")


def minutes_between(later: Column, earlier: Column) -> Column:
    return seconds_between(later, earlier).cast("double") / 60.0


def day_label(c: Column) -> Column:
    return F.date_format(c, "MMM dd")
