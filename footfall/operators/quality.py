"""Data-quality checks: each returns what fails, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.schema import STAGES


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()


# The checks the layers have to pass.
CHECKS = (
    Check("events_raw", "user_id", "not_null"),
    Check("events_raw", "event_type", "not_null"),
    Check("events_raw", "event_type", "accepted_values", STAGES),
    Check("events_raw", "event_time", "not_null"),
    Check("stg_events", "user_id", "not_null"),
    Check("stg_events", "event_type", "not_null"),
    Check("stg_events", "event_type", "accepted_values", STAGES),
    Check("stg_events", "event_at", "not_null"),
    Check("sessions", "session_key", "unique"),
    Check("sessions", "session_key", "not_null"),
    Check("sessions", "user_id", "not_null"),
    Check("funnel", "stage", "not_null"),
    Check("funnel", "stage", "accepted_values", STAGES),
    Check("cohort", "user_id", "unique"),
    Check("cohort", "user_id", "not_null"),
    Check("retention", "cohort_week", "not_null"),
    Check("retention", "week_number", "not_null"),
)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """The rows in which the column is missing."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL may repeat."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def _failures(check: Check) -> Column:
    """Failures of a check that any row can decide alone, as one aggregate.

    Counted like the check's own result: rows for not_null, distinct values for
    accepted_values.
    """
    c = F.col(check.column)
    if check.kind == "not_null":
        return F.count_if(c.isNull())
    if check.kind == "accepted_values":
        return F.countDistinct(F.when(~c.isin(*check.values), c))
    raise ValueError(f"unknown check {check.kind!r}")


def _outcome(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        failures.alias("failures"),
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check] = CHECKS) -> DataFrame:
    """One row per check with its number of failures, as one lazy DataFrame.

    All checks of a table share one pass. A ``unique`` check needs its values grouped; the
    row checks ride along as partial sums. Only a second ``unique`` column of a table, or
    ``accepted_values`` beside ``unique``, takes another pass.
    """
    results = []
    for table, group in groupby(sorted(checks, key=lambda c: c.table), key=lambda c: c.table):
        df, mine = tables[table], list(group)
        unique_on = [c for c in mine if c.kind == "unique"]
        nulls = [c for c in mine if c.kind == "not_null"]
        apart = [c for c in mine if c not in unique_on and c not in nulls]
        if unique_on:
            results.append(_grouped(df, unique_on[0], nulls))
        else:
            apart = nulls + apart
        if apart:
            results.append(_in_one_row(df.agg(*[_failures(c).alias(f"check_{i}") for i, c in enumerate(apart)]), apart))
        results += [_grouped(df, check, []) for check in unique_on[1:]]
    if not results:
        raise ValueError("no checks")
    union = reduce(DataFrame.unionByName, results)
    return union.withColumn("passed", F.col("failures") == 0)


def _in_one_row(one_row: DataFrame, checks: list[Check]) -> DataFrame:
    rows = [_outcome(c, F.col(f"check_{i}")) for i, c in enumerate(checks)]
    return one_row.select(F.inline(F.array(*rows)))


def _grouped(df: DataFrame, check: Check, nulls: list[Check]) -> DataFrame:
    """A unique check and the table's not_null checks from one grouping."""
    value = F.col(check.column).alias("value")
    partial = [F.count_if(F.col(c.column).isNull()).alias(f"null_{i}") for i, c in enumerate(nulls)]
    groups = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"), *partial)
    zero = F.lit(0).cast("bigint")
    totals = [F.coalesce(F.sum(f"null_{i}"), zero).alias(f"check_{i + 1}") for i in range(len(nulls))]
    repeated = F.count_if(F.col("value").isNotNull() & (F.col("n") > 1)).alias("check_0")
    return _in_one_row(groups.agg(repeated, *totals), [check, *nulls])


def require_passing(results: DataFrame) -> None:
    """Raise when a check failed. Collects at most one row per declared check."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in failed]
        raise ValueError("data-quality checks failed: " + "; ".join(sorted(lines)))
