"""Approximate distinct users from daily sketches that can be merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import day_of, month_start, week_start

LOG_SIZE = 14  # 2^14 registers of a byte a day
PERIODS = {"day": day_of, "week": week_start, "month": month_start}


def relative_error(log_size: int = LOG_SIZE) -> float:
    """One standard error of an estimate over merged sketches, as a share of the true number."""
    return 1.04 / 2 ** (log_size / 2)


def daily_sketches(events: DataFrame, log_size: int = LOG_SIZE) -> DataFrame:
    """(day, users): a HyperLogLog sketch of the known users of each day.

    A distinct count can't be added up over days, a sketch can be merged: with one small row a
    day kept, actives of any longer period need no event again. Sketches are made on the map
    side, so the shuffle carries one a day and task. Unknown users count for nothing.
    """
    return events.groupBy(day_of(F.col("event_at")).alias("day")).agg(
        F.hll_sketch_agg("user_id", log_size).alias("users")
    )


def active_users(sketches: DataFrame, unit: str) -> DataFrame:
    """(period, active_users) per day, week or month, estimated from daily sketches."""
    merged = sketches.groupBy(PERIODS[unit](F.col("day")).alias("period")).agg(F.hll_union_agg("users").alias("users"))
    return merged.select("period", F.hll_sketch_estimate("users").alias("active_users"))
