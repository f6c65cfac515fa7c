"""Acquisition cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import month_start, week_start
from footfall.schema import COHORT, conform


def assign_cohorts(events: DataFrame, at: str = "event_at") -> DataFrame:
    """One row per user: first event and the week and month it falls in. ``at`` names the time;
    rows may be folded as long as each user's first time is among them."""
    first = events.groupBy("user_id").agg(F.min(at).alias("first_event_at"))
    return conform(
        first.withColumns({
            "cohort_week": week_start(F.col("first_event_at")),
            "cohort_month": month_start(F.col("first_event_at")),
        }),
        COHORT,
    )
