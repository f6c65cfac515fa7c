"""KPI and daily-activity reports over staged events and sessions.

Several distinct counts in one aggregate make Spark repeat every input row once per
count. Here the events are first folded to one row per user, or per user and day or week,
with map-side combine; distinct counts then become plain sums over far fewer rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import (
    day_label,
    day_of,
    ratio_or_zero,
    rounded,
    rounded_ratio,
    seconds_between,
    week_start,
)
from footfall.schema import MONEY

def _is_purchase() -> Column:
    return F.col("event_type") == "purchase"


def _events() -> Column:
    return F.count(F.lit(1)).alias("events")


def _did(stage: str) -> Column:
    """1 for a known user with such an event; a group of unknown users is nobody."""
    known = F.col("user_id").isNotNull()
    return F.max(F.when(known & (F.col("event_type") == stage), 1).otherwise(0))


def _bought() -> Column:
    return _did("purchase").alias("bought")


def _spent() -> Column:
    return F.sum(F.when(_is_purchase(), F.col("price"))).alias("spent")


def _gmv() -> Column:
    return F.coalesce(F.sum("spent"), F.lit(0)).cast(MONEY)


def kpi_summary(events: DataFrame) -> DataFrame:
    """Users, sessions (by the source's own session id), buyers, revenue and events: one row.

    Users and sessions are folded in two branches, each reading its own few columns and
    grouping by its own key, and the two one-row results are added up.
    """
    per_user = events.groupBy("user_id").agg(_events(), _bought(), _spent())
    by_user = per_user.agg(
        F.count("user_id").alias("users"),
        F.sum("bought").alias("buyers"),
        F.sum("spent").alias("spent"),
        F.sum("events").alias("events"),
    )
    by_session = events.agg(F.countDistinct("session_id").alias("sessions"))
    both = by_user.unionByName(by_session, allowMissingColumns=True)

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(column)

    return both.agg(
        total("users"), total("sessions"), total("buyers"), _gmv().alias("gmv"), total("events")
    )


def headline_kpis(events: DataFrame) -> DataFrame:
    """The same figures under their headline names."""
    return kpi_summary(events).select(
        F.col("users").alias("total_users"),
        F.col("sessions").alias("total_sessions"),
        F.col("events").alias("total_events"),
        F.col("buyers").alias("paying_users"),
        "gmv",
    )


def kpi_ratios(events: DataFrame) -> DataFrame:
    """Conversion in percent and revenue per paying user; 0 where there is nobody to divide by."""
    return kpi_summary(events).select(
        (ratio_or_zero(F.col("buyers"), F.col("users")) * 100).alias("conversion_pct"),
        ratio_or_zero(F.col("gmv"), F.col("buyers")).alias("arppu"),
    )


def daily_active_users(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(day_of(F.col("event_at")).alias("day"))
        .agg(F.countDistinct("user_id").alias("dau"))
        .orderBy("day")
    )


def _daily(events: DataFrame) -> DataFrame:
    user_days = events.groupBy(day_of(F.col("event_at")).alias("day"), "user_id").agg(
        _events(), _bought(), _spent()
    )
    return user_days.groupBy("day").agg(
        F.count("user_id").alias("dau"),
        F.sum("bought").alias("buyers"),
        F.sum("events").alias("events"),
        _gmv().alias("gmv"),
    )


def daily_activity(events: DataFrame) -> DataFrame:
    """Active users, buyers, events and revenue per day."""
    return _daily(events).orderBy("day")


def peak_days(events: DataFrame) -> DataFrame:
    """The day with most users and the day with most revenue; the earliest one on a tie."""
    def earliest_peak(metric: str) -> Column:
        order = F.struct(F.col(metric), -F.unix_date("day"))
        return F.max_by(F.struct("day", metric), order)

    peaks = _daily(events).agg(
        earliest_peak("dau").alias("by_dau"), earliest_peak("gmv").alias("by_gmv")
    )
    return peaks.where("by_dau IS NOT NULL").select(
        F.col("by_dau.day").alias("peak_dau_day"),
        day_label(F.col("by_dau.day")).alias("peak_dau_label"),
        F.col("by_dau.dau").alias("peak_dau"),
        F.col("by_gmv.day").alias("peak_gmv_day"),
        day_label(F.col("by_gmv.day")).alias("peak_gmv_label"),
        F.col("by_gmv.gmv").alias("peak_gmv"),
    )


def day_lookup(events: DataFrame, day: dt.date) -> DataFrame:
    """Active users on one day; no row when the day has no events.

    The day is a range on the timestamp, which reaches the scan; a filter on the derived
    date would not.
    """
    start = F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")
    end = F.lit(dt.datetime.combine(day + dt.timedelta(days=1), dt.time())).cast("timestamp_ntz")
    on_day = events.where((F.col("event_at") >= start) & (F.col("event_at") < end))
    return daily_active_users(on_day)


def weekly_conversion(events: DataFrame) -> DataFrame:
    """Viewers, buyers and buyers per viewer, by week."""
    user_weeks = events.groupBy(week_start(F.col("event_at")).alias("week"), "user_id").agg(
        _did("view").alias("viewed"), _bought()
    )
    weeks = user_weeks.groupBy("week").agg(
        F.sum("viewed").alias("viewers"), F.sum("bought").alias("buyers")
    )
    rate = rounded_ratio(F.col("buyers"), F.col("viewers"), 4)
    return weeks.withColumn("conversion_rate", rate).orderBy("week")


def user_revenue(events: DataFrame) -> DataFrame:
    """Revenue per paying user, highest first; unpriced purchases only give NULL, on top."""
    return (
        events.where(_is_purchase())
        .groupBy("user_id")
        .agg(F.sum("price").cast(MONEY).alias("revenue"))
        .orderBy(F.desc_nulls_first("revenue"), "user_id")
    )


def session_averages(sessions: DataFrame) -> DataFrame:
    """Mean minutes and events per session and the share that bought: one row.

    The means are sums on exact types, so they do not depend on the order of the rows.
    """
    seconds = seconds_between(F.col("session_end"), F.col("session_start"))
    totals = sessions.agg(
        F.sum(seconds).alias("seconds"),
        F.sum("total_events").alias("events"),
        F.sum(F.col("converted").cast("int")).alias("converted"),
        F.count(F.lit(1)).alias("n"),
    )
    n = F.col("n").cast("decimal(18,0)")
    return totals.select(
        rounded(F.try_divide(F.col("seconds"), n * 60), 2).alias("avg_session_minutes"),
        rounded_ratio(F.col("events"), F.col("n"), 2).alias("avg_events_per_session"),
        rounded_ratio(F.col("converted") * 100, F.col("n"), 2).alias("session_conversion_pct"),
    )


def _category_purchases(events: DataFrame) -> DataFrame:
    category = F.coalesce("category_code", F.lit("unknown")).alias("category")
    return events.where(_is_purchase()).select(category, "user_id", "price")


def top_categories(events: DataFrame, k: int = 20) -> DataFrame:
    """The k categories with most purchase revenue. Categories with no known price lead."""
    totals = _category_purchases(events).groupBy("category").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("price").cast(MONEY).alias("revenue")
    )
    return totals.orderBy(F.desc_nulls_first("revenue"), "category").limit(k)


def top_category_buyers(events: DataFrame, k: int = 15) -> DataFrame:
    """Top categories with their buyers and average order value.

    The order value counts unpriced purchases in its denominator.
    """
    per_buyer = _category_purchases(events).groupBy("category", "user_id").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("price").alias("revenue")
    )
    totals = per_buyer.groupBy("category").agg(
        F.sum("purchases").alias("purchases"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.count("user_id").alias("buyers"),
    )
    top = totals.orderBy(F.desc_nulls_first("revenue"), "category").limit(k)
    return top.withColumn("aov", F.col("revenue").cast("double") / F.col("purchases"))
