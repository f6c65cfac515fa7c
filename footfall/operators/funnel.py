"""Conversion funnel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import ratio, week_start
from footfall.schema import FUNNEL, STAGES, conform


def first_touch(events: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """One row per user with ``first_<stage>_at``, NULL for a stage never reached."""
    return events.groupBy("user_id").agg(*[
        F.min(F.when(F.col("event_type") == stage, F.col("event_at"))).alias(f"first_{stage}_at")
        for stage in stages
    ])


def user_weeks(events: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """One row per user and week: the first event and the first of each stage. Cohorts, funnel
    and retention need no more of the events."""
    touches = [
        F.min(F.when(F.col("event_type") == stage, F.col("event_at"))).alias(f"first_{stage}_at")
        for stage in stages
    ]
    week = week_start(F.col("event_at")).alias("activity_week")
    return events.groupBy("user_id", week).agg(F.min("event_at").alias("first_event_at"), *touches)


def funnel_from_weeks(weeks: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """The funnel from ``user_weeks``."""
    return _funnel(weeks.groupBy("user_id").agg(*[
        F.min(f"first_{stage}_at").alias(f"first_{stage}_at") for stage in stages
    ]), stages)


def funnel(events: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Users who ever reached each stage, as a share of the first and the previous stage.

    Order in time does not matter: buying without viewing counts. The top stage is 1.0 of
    itself even when empty. Without any events there are still rows, with NULL users.

    The stages are unrolled from the single aggregate row; a union of one branch per stage
    would scan the events once per branch.
    """
    return _funnel(first_touch(events, stages), stages)


def _funnel(touches: DataFrame, stages: Sequence[str]) -> DataFrame:
    reached = [F.col(f"first_{stage}_at").isNotNull() for stage in stages]
    counts = touches.agg(*[
        F.sum(F.when(flag, 1).otherwise(0)).alias(stage) for stage, flag in zip(stages, reached)
    ])
    rows = []
    for i, stage in enumerate(stages):
        users = F.col(f"`{stage}`")
        if i == 0:
            of_top = of_prev = F.lit(1.0)
        else:
            of_top = ratio(users, F.col(f"`{stages[0]}`"))
            of_prev = ratio(users, F.col(f"`{stages[i - 1]}`"))
        rows.append(F.struct(
            F.lit(stage).alias("stage"),
            F.lit(i + 1).alias("stage_order"),
            users.alias("users"),
            of_top.alias("pct_of_top"),
            of_prev.alias("pct_of_prev"),
        ))
    return conform(counts.select(F.inline(F.array(*rows))), FUNNEL)
