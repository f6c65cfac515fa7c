"""Column contracts of the layers, as ordered ``name -> Spark type`` maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

STAGES = ("view", "cart", "purchase")

RAW_EVENTS = {
    "event_time": "timestamp_ntz",
    "event_type": "string",
    "product_id": "bigint",
    "category_id": "bigint",
    "category_code": "string",
    "brand": "string",
    "price": "decimal(10,2)",
    "user_id": "bigint",
    "user_session": "string",
}

STG_EVENTS = {
    "event_at": "timestamp_ntz",
    "event_type": "string",
    "product_id": "bigint",
    "category_id": "bigint",
    "category_code": "string",
    "brand": "string",
    "price": "decimal(10,2)",
    "user_id": "bigint",
    "session_id": "string",
    "user_session": "string",
}

SESSIONS = {
    "session_key": "string",
    "user_id": "bigint",
    "session_seq": "bigint",
    "session_start": "timestamp_ntz",
    "session_end": "timestamp_ntz",
    "duration_minutes": "double",
    "total_events": "bigint",
    "views": "bigint",
    "carts": "bigint",
    "purchases": "bigint",
    "revenue": "decimal(20,2)",
    "converted": "boolean",
}

COHORT = {
    "user_id": "bigint",
    "first_event_at": "timestamp_ntz",
    "cohort_week": "date",
    "cohort_month": "date",
}

FUNNEL = {
    "stage": "string",
    "stage_order": "int",
    "users": "bigint",
    "pct_of_top": "double",
    "pct_of_prev": "double",
}

RETENTION = {
    "cohort_week": "date",
    "week_number": "int",
    "retained_users": "bigint",
    "cohort_users": "bigint",
    "retention_rate": "double",
}

MONEY = "decimal(20,2)"


def conform(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Select the contract's columns in order, cast to its types."""
    return df.selectExpr(*[f"CAST({name} AS {kind}) AS {name}" for name, kind in contract.items()])
