"""Buyers scored by recency, frequency and money, and the segments that follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.functions import day_of
from footfall.schema import MONEY

SCORES = 5
MEASURES = ("recency", "frequency", "money")


def _three_digits(n: Column) -> Column:
    """A whole number with all digits after the third set to 0."""
    digits = n.cast("string")
    return F.rpad(F.substring(digits, 1, 3), F.length(digits), "0").cast("bigint")


def _buyers(events: DataFrame) -> DataFrame:
    buyers = events.where("event_type = 'purchase' AND user_id IS NOT NULL").groupBy("user_id").agg(
        F.max(day_of(F.col("event_at"))).alias("last_day"),
        F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum("price"), F.lit(0)).cast(MONEY).alias("spent"),
    )
    values = {
        "recency": F.unix_date("last_day").cast("bigint"),
        "frequency": _three_digits(F.col("orders")),
        "money": _three_digits((F.greatest("spent", F.lit(0)) * 100).cast("bigint")),
    }
    return buyers.select(
        "user_id", "last_day", "orders", "spent",
        F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), values[m].alias("value")) for m in MEASURES])),
    )


def rfm_scores(events: DataFrame) -> DataFrame:
    """Each buyer's last day, purchases, revenue, their scores from 1 to 5, and a segment.

    A score is 1 plus the whole fifths of buyers with a smaller value, so equal values score
    alike. Frequency and money are compared by their first three digits. So the cuts come from
    a count per value, of which there are 900 for each further digit and one for each day, whatever
    the number of buyers: buyers are not sorted, and the window sees that small table only.
    Scores go back by one join over (measure, value), and a buyer's three rows still lie in one
    partition when they are folded. Revenue below 0 is compared as 0.
    """
    rows = _buyers(events)
    counts = rows.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
    mine = W.partitionBy("measure")
    below = F.coalesce(F.sum("n").over(mine.orderBy("value").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cuts = counts.select("measure", "value", below.alias("below"), F.sum("n").over(mine).alias("total"))
    cuts = cuts.select("measure", "value", F.expr(f"CAST(1 + ({SCORES} * below) DIV total AS INT)").alias("score"))
    scored = rows.join(cuts, ["measure", "value"]).groupBy("user_id").agg(
        *[F.max(c).alias(c) for c in ("last_day", "orders", "spent")],
        *[F.max(F.when(F.col("measure") == m, F.col("score"))).alias(m) for m in MEASURES],
    )
    recent, often = F.col("recency"), F.col("frequency")
    segment = (
        F.when((recent >= 4) & (often >= 4), "champions").when(often >= 4, "loyal").when(recent >= 4, "recent")
        .when((recent <= 2) & (often <= 2), "lost").when(recent <= 2, "at risk").otherwise("steady")
    )
    return scored.withColumn("segment", segment)


def rfm_segments(events: DataFrame) -> DataFrame:
    """Buyers, purchases and revenue of each segment."""
    return (
        rfm_scores(events).groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("buyers"), F.sum("orders").alias("orders"),
            F.sum("spent").cast(MONEY).alias("revenue"),
        )
        .orderBy("segment")
    )
