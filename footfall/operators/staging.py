"""Raw events -> typed, cleaned, filtered events.

The rules are kept as SQL expressions because the staging layer is a catalog view, and a
catalog view is stored as SQL; the DataFrame form uses the very same expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.schema import STAGES

# The type list looks at the raw text: ' view' or 'VIEW' is dropped, not repaired.
KEEP = "event_type IN ({}) AND user_id IS NOT NULL AND event_time IS NOT NULL".format(
    ", ".join(f"'{stage}'" for stage in STAGES)
)


def _no_blank(column: str) -> str:
    return f"nullif(trim({column}), '')"


COLUMNS = {
    "event_at": "CAST(event_time AS TIMESTAMP_NTZ)",
    "event_type": "lower(trim(event_type))",
    "product_id": "product_id",
    "category_id": "category_id",
    "category_code": _no_blank("category_code"),
    "brand": _no_blank("brand"),
    "price": "CAST(price AS DECIMAL(10, 2))",
    "user_id": "user_id",
    "session_id": _no_blank("user_session"),
    "user_session": _no_blank("user_session"),
}

_SELECT = [f"{rule} AS {name}" for name, rule in COLUMNS.items()]


def stage_events(raw: DataFrame) -> DataFrame:
    """Narrow: the filter and the column set reach the scan, nothing is shuffled.

    Events are not de-duplicated.
    """
    return raw.where(KEEP).selectExpr(*_SELECT)


def staging_sql(source: str) -> str:
    """The SELECT behind the staging view over the table ``source``."""
    return f"SELECT {', '.join(_SELECT)} FROM {source} WHERE {KEEP}"
