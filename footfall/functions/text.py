"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a CSV reader of the pandas family takes for a missing value.
NULL_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def normalise(c: Column) -> Column:
    return F.lower(F.trim(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def null_words(c: Column) -> Column:
    """NULL for a field that is exactly one of the missing-value words."""
    return F.when(~c.isin(*NULL_WORDS), c)


def remove_text(c: Column, text: str) -> Column:
    return F.replace(c, F.lit(text), F.lit(""))
