"""Sessions by inactivity gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import minutes_between, surrogate_key
from footfall.schema import MONEY, SESSIONS, conform

GAP = "30 minutes"


def _count_of(stage: str) -> Column:
    return F.sum(F.when(F.col("event_type") == stage, 1).otherwise(0))


def sessionize(events: DataFrame, gap: str = GAP) -> DataFrame:
    """One row per user session; a session ends at a silence strictly longer than ``gap``.

    A window function over the events would put every event of a user into one task, and
    one user may own a large share of all events. So events are first folded into slots as
    long as the gap. Two events in one slot are closer than the gap, so a slot never
    straddles a session boundary and the fold is exact. It is a plain hash aggregate with
    map-side combine: a hot user leaves each task as one row per slot.

    The windows then run over slots. A user has at most one slot per gap of calendar time
    (17,520 a year for 30 minutes), however many events they sent.

    Events of a user at the same instant share a slot, hence a session.
    """
    is_purchase = F.col("event_type") == "purchase"
    slots = (
        events.select(
            "user_id", "event_type", "price", "event_at",
            F.window("event_at", gap)["start"].alias("slot"),
        )
        .groupBy("user_id", "slot")
        .agg(
            F.min("event_at").alias("slot_first"),
            F.max("event_at").alias("slot_last"),
            F.count(F.lit(1)).alias("total_events"),
            _count_of("view").alias("views"),
            _count_of("cart").alias("carts"),
            _count_of("purchase").alias("purchases"),
            # NULL only where every row is a purchase without a price.
            F.sum(F.when(is_purchase, F.col("price")).otherwise(0)).alias("revenue"),
        )
    )

    by_time = Window.partitionBy("user_id").orderBy("slot")
    silence = F.col("slot_first") - F.lag("slot_last").over(by_time)
    continues = silence <= F.expr(f"INTERVAL '{gap}'")
    numbered = slots.withColumn(
        "starts_session", F.when(continues, 0).otherwise(1)
    ).withColumn(
        "session_seq",
        F.sum("starts_session").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )

    sessions = numbered.groupBy("user_id", "session_seq").agg(
        F.min("slot_first").alias("session_start"),
        F.max("slot_last").alias("session_end"),
        *[F.sum(c).alias(c) for c in ("total_events", "views", "carts", "purchases")],
        F.sum("revenue").cast(MONEY).alias("revenue"),
    )
    return conform(
        sessions.withColumns({
            "session_key": surrogate_key(F.col("user_id"), F.col("session_seq")),
            "duration_minutes": minutes_between(F.col("session_end"), F.col("session_start")),
            "converted": F.col("purchases") > 0,
        }),
        SESSIONS,
    )
