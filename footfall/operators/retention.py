"""Weekly retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import rounded_ratio, week_start, weeks_between
from footfall.schema import RETENTION, conform


def _user_weeks(events: DataFrame) -> DataFrame:
    """Distinct (user, week): from here on a user has at most one row per calendar week."""
    return events.select("user_id", week_start(F.col("event_at")).alias("activity_week")).distinct()


def retention_from_weeks(weeks: DataFrame) -> DataFrame:
    """Retention from distinct (user_id, activity_week) rows, such as ``user_weeks`` gives."""
    return _rates(_cells_from_first_week(weeks.select("user_id", "activity_week")))


def retention(events: DataFrame, cohort: DataFrame | None = None) -> DataFrame:
    """Users of a cohort week active ``week_number`` weeks later, and their share of it.

    Weeks without a returning user have no row.

    Without ``cohort`` the cohort week is the user's first active week, which is the week of
    the first event, so one scan of the events is enough and nothing is joined. With
    ``cohort`` (say, a written table) its weeks are used and users outside it are left out.
    """
    if cohort is None:
        return _rates(_cells_from_first_week(_user_weeks(events)))
    return _rates(_cells_from_cohort(events, cohort))


def _rates(cells: DataFrame) -> DataFrame:
    rate = rounded_ratio(F.col("retained_users"), F.col("cohort_users"), 4)
    return conform(cells.withColumn("retention_rate", rate), RETENTION)


def _cells_from_first_week(weeks: DataFrame) -> DataFrame:
    first_week = F.min("activity_week").over(Window.partitionBy("user_id"))
    weeks_in = weeks_between(F.col("activity_week"), F.col("cohort_week"))
    cells = (
        weeks
        .withColumn("cohort_week", first_week)
        .groupBy("cohort_week", weeks_in.alias("week_number"))
        .agg(F.count(F.lit(1)).alias("retained_users"))
    )
    # Everyone is active in their own first week, so week 0 holds the cohort size.
    in_week_0 = F.when(F.col("week_number") == 0, F.col("retained_users"))
    return cells.withColumn("cohort_users", F.max(in_week_0).over(Window.partitionBy("cohort_week")))


def _cells_from_cohort(events: DataFrame, cohort: DataFrame) -> DataFrame:
    members = cohort.select("user_id", "cohort_week")
    size = members.groupBy("cohort_week").agg(F.countDistinct("user_id").alias("cohort_users"))
    cells = (
        members.join(_user_weeks(events), "user_id")
        .where(F.col("activity_week") >= F.col("cohort_week"))
        .groupBy(
            "cohort_week",
            weeks_between(F.col("activity_week"), F.col("cohort_week")).alias("week_number"),
        )
        .agg(F.countDistinct("user_id").alias("retained_users"))
    )
    # One row per cohort week on both sides of the key; the planner picks by measured size.
    return cells.join(size, "cohort_week")
