"""Partitioned and clustered layouts of the published tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import day_of

FOLDER_ROWS = 100_000  # that a folder holds on average, at least
COARSER = ("month", "year")
FOLDER = "folder"  # name of a folder column that stands for several dates


@dataclass(frozen=True)
class Layout:
    """Folders by a date column, or by a coarser unit of it if the dates are mostly small; files
    clustered within."""

    partition: str | None = None
    cluster: tuple[str, ...] = ()
    required: tuple[str, ...] = ()


LAYOUTS = {
    "funnel": Layout(required=("stage", "stage_order", "users")),
    "cohort": Layout("cohort_month", ("user_id",), ("user_id",)),
    "retention": Layout("cohort_week", ("week_number",), ("cohort_week", "week_number")),
    "sessions": Layout("session_date", ("user_id",), ("session_key",)),
}


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """The same rows; a NULL in a required column fails the job that reads them.

    The test rides along with the write, so the rows are not computed twice.
    """
    def checked(name: str) -> Column:
        complaint = F.raise_error(F.lit(f"required column {name} is NULL"))
        return F.when(F.col(name).isNull(), complaint).otherwise(F.col(name))

    return df.withColumns({name: checked(name) for name in required})


def arrange(df: DataFrame, layout: Layout, files: int | None = None) -> DataFrame:
    """Rows sorted for the layout and spread evenly over the writing tasks.

    Ranges over (partition, cluster) cut a partition that is larger than the others into
    several files with disjoint cluster ranges, where hashing on the partition column would
    send it to one task whole. Readers skip files by their min/max statistics.
    """
    keys = [k for k in (layout.partition, *layout.cluster) if k]
    if not keys:
        return df
    ranges = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranges.sortWithinPartitions(*keys)


def folders(df: DataFrame, date: str, least: int = FOLDER_ROWS) -> Column | None:
    """The finest of the date itself, its month and its year of which a folder has ``least`` rows
    on average; null if all rows together have fewer than two such folders."""
    units = {"date": F.col(date), **{u: F.trunc(date, u) for u in COARSER}}
    facts = df.agg(F.count("*").alias("rows"), *[F.count_distinct(v).alias(u) for u, v in units.items()]).first()
    for unit, value in units.items():
        if facts[unit] and facts["rows"] >= least * facts[unit]:
            return value if facts[unit] > 1 else None
    return None


def write_layout(df: DataFrame, name: str, path: str, files: int | None = None, least: int = FOLDER_ROWS) -> None:
    """Write a published table in its layout, replacing an earlier one.

    ``df`` should be a written table: its dates are counted first, then laying out by ranges
    looks at it twice. Many small dates would each be a folder with a tiny file, so folders
    stand for a month or a year then, or there is one folder. Whatever the unit, files are
    ranges of (date, cluster), so readers that look for a date skip the others by statistics.
    """
    layout = LAYOUTS[name]
    if name == "sessions":
        df = df.withColumn("session_date", day_of(F.col("session_start")))
    rows = arrange(require_columns(df, layout.required), layout, files)
    unit = folders(df, layout.partition, least) if layout.partition else None
    if unit is None:
        rows.write.mode("overwrite").parquet(path)
    else:
        rows.withColumn(FOLDER, unit).write.mode("overwrite").partitionBy(FOLDER).parquet(path)


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """A laid out table, with the columns that were written."""
    found = spark.read.parquet(path)
    return found.drop(FOLDER)
