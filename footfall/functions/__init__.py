"""Column functions shared by the operators; each one returns a built-in Spark expression."""

from footfall.functions.dates import (
    day_label,
    day_of,
    minutes_between,
    month_start,
    seconds_between,
    week_start,
    weeks_between,
)
from footfall.functions.keys import hash_bucket, surrogate_key
from footfall.functions.numbers import (
    exact,
    fraction_pct,
    ratio,
    ratio_or_zero,
    rounded,
    rounded_ratio,
)
from footfall.functions.text import NULL_WORDS, blank_to_null, normalise, null_words, remove_text

__all__ = [
    "NULL_WORDS",
    "blank_to_null",
    "day_label",
    "day_of",
    "exact",
    "fraction_pct",
    "hash_bucket",
    "minutes_between",
    "month_start",
    "normalise",
    "null_words",
    "ratio",
    "ratio_or_zero",
    "remove_text",
    "rounded",
    "rounded_ratio",
    "seconds_between",
    "surrogate_key",
    "week_start",
    "weeks_between",
]
