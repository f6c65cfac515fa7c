"""Report snapshots: one parquet folder per named report, and a manifest of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.plans.activity import daily_activity, kpi_summary, top_category_buyers
from footfall.sources.layers import STAGING_VIEW, TABLES


@dataclass(frozen=True)
class Report:
    """A report over one layer table. ``small`` tells that its rows do not grow with the
    number of users or events, so one file can hold them."""

    table: str
    build: Callable[[DataFrame], DataFrame]
    small: bool = True


REPORTS = {
    "kpi_summary": Report(STAGING_VIEW, kpi_summary),
    "funnel": Report(TABLES["funnel"], lambda funnel: funnel.orderBy("stage_order")),
    "retention": Report(
        TABLES["retention"],
        lambda retention: retention.select(
            "cohort_week", "week_number", "retention_rate", "cohort_users"
        ).orderBy("cohort_week", "week_number"),
    ),
    "daily_activity": Report(STAGING_VIEW, daily_activity),
    "top_categories": Report(STAGING_VIEW, lambda events: top_category_buyers(events).drop("aov")),
    # One row per user: kept in as many files as it takes.
    "cohort": Report(TABLES["cohort"], lambda cohort: cohort, small=False),
}

STANDARD = ("kpi_summary", "funnel", "retention", "daily_activity", "top_categories")


def export_snapshots(
    tables: Mapping[str, DataFrame], out_dir: str, names: Iterable[str] = STANDARD
) -> None:
    """Write the named reports below ``out_dir``, replacing earlier ones.

    ``tables`` maps layer table names to frames.
    """
    for name in names:
        report = REPORTS[name]
        result = report.build(tables[report.table])
        if report.small:
            result = result.coalesce(1)
        result.write.mode("overwrite").parquet(f"{out_dir}/{name}")


def snapshot_manifest(spark: SparkSession, out_dir: str, names: Iterable[str] = STANDARD) -> DataFrame:
    """Rows and bytes per snapshot, and a ``total`` row.

    Neither reads any data: rows come from the parquet footers, bytes from the file listing.
    """
    def facts(name: str) -> list[DataFrame]:
        path = f"{out_dir}/{name}"
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        label = F.lit(name).alias("snapshot")
        none = F.lit(0).cast("bigint")
        return [
            spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
            .select(label, "rows", none.alias("bytes")),
            files.agg(F.coalesce(F.sum("length"), none).alias("bytes"))
            .select(label, none.alias("rows"), "bytes"),
        ]

    every = reduce(DataFrame.unionByName, [fact for name in names for fact in facts(name)])
    return every.rollup("snapshot").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")
    ).fillna("total", ["snapshot"])


def load_report(spark: SparkSession, name: str, snapshot_dir: str, live: bool) -> DataFrame:
    """A named report, as the caller decides: live from its layer table, or its snapshot."""
    report = REPORTS[name]
    if live:
        return report.build(spark.table(report.table))
    try:
        return spark.read.parquet(f"{snapshot_dir}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(
            f"snapshot {snapshot_dir}/{name} does not exist"
        ) from e
