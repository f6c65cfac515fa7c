"""Ratios and rounding.

Unrounded ratios are doubles. Rounded ones are taken on decimals, so that a half always
rounds away from zero, and are published as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(c: Column, kind: str = "decimal(20,0)") -> Column:
    return c.cast(kind)


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den as double; 0 when den is zero or missing."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def rounded(c: Column, places: int) -> Column:
    """Round a decimal half away from zero and publish it as double."""
    return F.round(c, places).cast("double")


def rounded_ratio(num: Column, den: Column, places: int) -> Column:
    """num / den rounded on decimals; NULL when den is zero."""
    return rounded(F.try_divide(exact(num), exact(den)), places)


def fraction_pct(c: Column, places: int) -> Column:
    """A fraction as a percentage, rounded."""
    return rounded(exact(c, "decimal(28,18)") * 100, places)
