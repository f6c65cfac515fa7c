"""Reports over the three-row funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import exact, fraction_pct, rounded


def funnel_dropoff(funnel: DataFrame) -> DataFrame:
    """Stage shares in percent and the share lost since the previous stage."""
    kept = exact(F.col("pct_of_prev"), "decimal(28,18)")
    return funnel.orderBy("stage_order").select(
        "stage",
        "users",
        fraction_pct(F.col("pct_of_top"), 2).alias("pct_of_top"),
        fraction_pct(F.col("pct_of_prev"), 2).alias("pct_of_prev"),
        rounded((1 - kept) * 100, 2).alias("drop_off_pct"),
    )


def funnel_stage_rates(funnel: DataFrame) -> DataFrame:
    """View to cart, cart to purchase and overall conversion in percent: one row."""
    def rate(stage: str, column: str) -> Column:
        return F.max(F.when(F.col("stage") == stage, F.col(column) * 100))

    return funnel.agg(
        rate("cart", "pct_of_prev").alias("view_to_cart_pct"),
        rate("purchase", "pct_of_prev").alias("cart_to_purchase_pct"),
        rate("purchase", "pct_of_top").alias("overall_pct"),
    )


def funnel_chart(funnel: DataFrame) -> DataFrame:
    """What a funnel chart shows: title-case labels, users, share of the top stage."""
    return funnel.orderBy("stage_order").select(
        F.initcap("stage").alias("stage_label"), "users", "pct_of_top"
    )
