"""Reports over the retention table: one row per cohort week and week number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import exact, rounded
from footfall.schema import MONEY

# A rate has four places, so this holds it exactly and sums do not depend on row order.
RATE = "decimal(10,4)"


def retention_curve(retention: DataFrame) -> DataFrame:
    """Unweighted mean over the cohorts that have a row for the week; absent is not zero."""
    rates = F.sum(exact(F.col("retention_rate"), RATE))
    present = F.count("retention_rate").cast("decimal(18,0)")
    return (
        retention.groupBy("week_number")
        .agg(
            rounded(F.try_divide(rates * 100, present), 2).alias("avg_retention_pct"),
            F.sum("retained_users").alias("total_retained"),
        )
        .orderBy("week_number")
    )


def retention_matrix(retention: DataFrame, weeks: Sequence[int] = (0, 1, 2, 3, 4)) -> DataFrame:
    """Cohorts by weeks ``w0``, ``w1``, ...; a week without a row stays NULL."""
    return (
        retention.groupBy("cohort_week", "cohort_users")
        .pivot("week_number", list(weeks))
        .agg(F.max("retention_rate"))
        .withColumnsRenamed({str(week): f"w{week}" for week in weeks})
        .orderBy("cohort_week")
    )


def heatmap_cells(retention: DataFrame) -> DataFrame:
    """Retention in percent, a row per cohort and week that occurs: all cells of the heat map,
    in columns that do not depend on the data."""
    pct = (F.col("retention_rate") * 100).alias("pct")
    return retention.select("cohort_week", "week_number", pct).orderBy("cohort_week", "week_number")


def retention_heatmap(retention: DataFrame, weeks: Sequence[int] | None = None) -> DataFrame:
    """Retention in percent, cohorts by weeks, one column per week that occurs.

    The columns of a frame must be known before it runs. Give ``weeks`` when they are known;
    otherwise Spark runs the retention plan once to find them, so hand in a written table.
    """
    by_week = heatmap_cells(retention).groupBy("cohort_week").pivot("week_number", None if weeks is None else list(weeks))
    return by_week.agg(F.first("pct")).orderBy("cohort_week")


def best_cohorts(retention: DataFrame, week: int = 1, k: int = 10) -> DataFrame:
    """The k cohorts that came back most in the given week; the earlier one on a tie."""
    return (
        retention.where(F.col("week_number") == week)
        .select("cohort_week", "cohort_users", F.col("retention_rate").alias(f"week_{week}_retention"))
        .orderBy(F.desc_nulls_first(f"week_{week}_retention"), "cohort_week")
        .limit(k)
    )


def _mean_rate() -> Column:
    total = F.sum(exact(F.col("retention_rate"), RATE)).cast("double")
    return F.try_divide(total, F.count("retention_rate"))


def retention_curve_pct(retention: DataFrame) -> DataFrame:
    """The mean rate per week, as a fraction and in percent, unrounded."""
    curve = retention.groupBy("week_number").agg(_mean_rate().alias("retention_rate"))
    return curve.withColumn("retention_pct", F.col("retention_rate") * 100).orderBy("week_number")


def retention_drop_pp(retention: DataFrame, first: int = 1, second: int = 2) -> DataFrame:
    """Percentage points lost between two weeks of the mean curve.

    No row unless both weeks exist and neither is zero.
    """
    def pct(week: int) -> Column:
        return F.max(F.when(F.col("week_number") == week, F.col("retention_pct")))

    named = {f"week_{first}_pct": pct(first), f"week_{second}_pct": pct(second)}
    two = (
        retention_curve_pct(retention.where(F.col("week_number").isin(first, second)))
        .agg(*[c.alias(name) for name, c in named.items()])
    )
    a, b = (F.col(name) for name in named)
    return two.where((a != 0) & (b != 0)).withColumn("drop_pp", a - b)


def cohort_value(sessions: DataFrame, cohort: DataFrame) -> DataFrame:
    """Users, sessions, sessions with a purchase, and revenue of each monthly cohort.

    Sessions are folded to a row per user before they meet the cohort table. If both tables are
    bucketed by user (``sources.bucketed``) neither step shuffles.
    """
    per_user = sessions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("converted").alias("converted"), F.sum("revenue").alias("spent"),
    )
    joined = cohort.select("user_id", "cohort_month").join(per_user, "user_id")
    return joined.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("users"), F.sum("sessions").alias("sessions"), F.sum("converted").alias("converted"),
        F.sum("spent").cast(MONEY).alias("revenue"),
    )
