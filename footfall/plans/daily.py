"""The daily rebuild: load, stage, build the marts, check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.operators import (
    assign_cohorts,
    funnel_from_weeks,
    require_passing,
    retention_from_weeks,
    run_checks,
    sessionize,
    user_weeks,
)
from footfall.sources.layers import (
    RAW_TABLE,
    TABLES,
    create_layers,
    reload_raw_events,
    replace_staging_view,
    replace_table,
)
from footfall.sources.warehouse import write_layout

USER_WEEKS = "intermediate.user_weeks"


def build_marts(spark: SparkSession, prefix: str = "") -> None:
    """Rebuild the staging view and every table behind it.

    Staging stays a view. The events are read twice: for sessions, and folded to a row per
    user and week, written once, from which cohorts, funnel and retention come.
    """
    events = replace_staging_view(spark, prefix)
    table = {name: prefix + full for name, full in TABLES.items()}
    replace_table(sessionize(events), table["sessions"])
    weeks = replace_table(user_weeks(events), prefix + USER_WEEKS)
    replace_table(assign_cohorts(weeks, "first_event_at"), table["cohort"])
    replace_table(funnel_from_weeks(weeks), table["funnel"])
    replace_table(retention_from_weeks(weeks), table["retention"])


def check_layers(spark: SparkSession, prefix: str = "") -> DataFrame:
    tables = {name: spark.table(prefix + table) for name, table in TABLES.items()}
    tables["events_raw"] = spark.table(prefix + RAW_TABLE)
    tables["stg_events"] = replace_staging_view(spark, prefix)
    return run_checks(tables)


def publish(spark: SparkSession, out_dir: str) -> None:
    """Copy the tables into their partitioned, clustered layouts below ``out_dir``.

    Reads the written tables: laying out by ranges looks at its input twice.
    """
    for name, table in TABLES.items():
        write_layout(spark.table(table), name, f"{out_dir}/{name}")


def run_daily(spark: SparkSession, csv_path: str, prefix: str = "") -> int:
    """Rebuild everything from the CSV; raises when a data-quality check fails.

    Returns the number of raw rows loaded.
    """
    create_layers(spark, prefix)
    rows = reload_raw_events(spark, csv_path, prefix)
    build_marts(spark, prefix)
    require_passing(check_layers(spark, prefix))
    return rows
