"""User-level sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import hash_bucket, ratio

BUCKETS = 10_000


def sample_users(events: DataFrame, fraction: float = 0.05, seed: int = 42) -> DataFrame:
    """Keep a share of the users, each with all of their events.

    The choice hangs on a hash of the user id, so it needs no shuffle and comes out the same
    in every run and for every file layout. ``fraction`` is resolved to 1/10,000; one that
    would round to nothing is an error.
    """
    buckets = round(fraction * BUCKETS)
    if buckets == 0 and fraction > 0:
        raise ValueError(f"fraction {fraction} is below half of 1/{BUCKETS}")
    return events.where(hash_bucket(F.col("user_id"), seed, BUCKETS) < buckets)


def sample_fidelity(sample: DataFrame, full: DataFrame) -> DataFrame:
    """Event-type shares of a sample and of the full data, and how far they lie apart.

    Both sides are counted per event type before they meet, one row per type, and these counts
    add up to the totals. Types that only the sample has count for nothing.
    """
    def counts(events: DataFrame, name: str) -> DataFrame:
        return events.groupBy("event_type").agg(F.count(F.lit(1)).alias(name))

    def total(name: str) -> Column:
        return F.sum(name).over(Window.partitionBy())

    both = counts(full, "full_events").alias("f").join(
        counts(sample, "sample_events").alias("s"),
        F.col("f.event_type").eqNullSafe(F.col("s.event_type")),
        "left",
    ).select(
        "f.event_type",
        "full_events",
        F.coalesce("sample_events", F.lit(0).cast("bigint")).alias("sample_events"),
    )
    shares = both.withColumns({
        "full_share": ratio(F.col("full_events"), total("full_events")),
        "sample_share": ratio(F.col("sample_events"), total("sample_events")),
    })
    return shares.withColumn("share_gap", F.abs(F.col("sample_share") - F.col("full_share")))
