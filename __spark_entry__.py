"""

Every query runs over a whole test table, seen as click events by one of two adapters:
``events`` (one cohort week) and ``orders`` (many cohort weeks, events at equal times; keys
end in ``_orders``).

The oracles are written apart from the Spark code: sessions by windows over single events
instead of slots, retention by a join instead of a window, kpis by distinct counts instead of
roll-ups, rounding in integers instead of decimals.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import (
    accepted_values,
    active_users,
    assign_cohorts,
    daily_sketches,
    funnel,
    not_null,
    relative_error,
    retention,
    run_checks,
    sample_fidelity,
    sample_users,
    sessionize,
    stage_events,
    unique,
)
from footfall.operators.sketches import PERIODS
from footfall.plans import activity, conversion, loyalty, segments
from footfall.plans.daily import build_marts, check_layers
from footfall.schema import RAW_EVENTS, STAGES
from footfall.session import scratch_path
from footfall.sources import (
    create_layers,
    drop_layers,
    events_as_clicks,
    export_snapshots,
    load_report,
    orders_as_clicks,
    query,
    read_events_csv,
    read_layout,
    reload_raw_events,
    snapshot_manifest,
    write_bucketed,
    write_layout,
)
from footfall.sources.layers import RAW_TABLE, STAGING_VIEW, TABLES

try:
    import corpus_pipeline
    from footfall.llm import queries as corpus_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "footfall.llm"):
        raise
    CORPUS_QUERIES, CORPUS_SQL = {}, {}
else:
    CORPUS_QUERIES = corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    CORPUS_SQL = corpus_queries.ORACLE_SQL

ENTRY_DIR = "/root/testdata/sf0.001"

ADAPTERS = {"": events_as_clicks, "_orders": orders_as_clicks}
BUCKETS_HERE = 16
LOOKUP_DAY = {"": dt.date(2024, 1, 15), "_orders": dt.date(1998, 6, 15)}


# --- queries -----------------------------------------------------------------------------

# name -> query over (raw events, staged events)
OVER_EVENTS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "stg_events": lambda raw, stg: stg,
    "sessions": lambda raw, stg: sessionize(stg),
    "cohort": lambda raw, stg: assign_cohorts(stg),
    "funnel": lambda raw, stg: funnel(stg),
    "retention": lambda raw, stg: retention(stg),
    "retention_from_cohort": lambda raw, stg: retention(stg, assign_cohorts(stg)),
    "funnel_dropoff": lambda raw, stg: conversion.funnel_dropoff(funnel(stg)),
    "weekly_conversion": lambda raw, stg: activity.weekly_conversion(stg),
    "top_categories_20": lambda raw, stg: activity.top_categories(stg, 20),
    "headline_kpis": lambda raw, stg: activity.headline_kpis(stg),
    "dau": lambda raw, stg: activity.daily_active_users(stg),
    "user_revenue": lambda raw, stg: activity.user_revenue(stg),
    "session_averages": lambda raw, stg: activity.session_averages(sessionize(stg)),
    "retention_curve": lambda raw, stg: loyalty.retention_curve(retention(stg)),
    "retention_matrix": lambda raw, stg: loyalty.retention_matrix(retention(stg)),
    "retention_heatmap": lambda raw, stg: loyalty.heatmap_cells(retention(stg)),
    "best_cohorts_w1": lambda raw, stg: loyalty.best_cohorts(retention(stg)),
    "kpi_summary": lambda raw, stg: activity.kpi_summary(stg),
    "kpi_ratios": lambda raw, stg: activity.kpi_ratios(stg),
    "funnel_stage_rates": lambda raw, stg: conversion.funnel_stage_rates(funnel(stg)),
    "funnel_chart": lambda raw, stg: conversion.funnel_chart(funnel(stg)),
    "retention_curve_pct": lambda raw, stg: loyalty.retention_curve_pct(retention(stg)),
    "retention_drop_pp": lambda raw, stg: loyalty.retention_drop_pp(retention(stg)),
    "daily_activity": lambda raw, stg: activity.daily_activity(stg),
    "peak_days": lambda raw, stg: activity.peak_days(stg),
    "top_categories_15": lambda raw, stg: activity.top_category_buyers(stg, 15),
    "check_not_null": lambda raw, stg: not_null(stg, "category_code"),
    "check_unique": lambda raw, stg: unique(stg, "user_session"),
    "check_accepted_values": lambda raw, stg: accepted_values(raw, "event_type", STAGES[:2]),
    "check_suite": lambda raw, stg: _check_suite(raw, stg),
    "user_sample": lambda raw, stg: sample_users(raw),
    "sample_fidelity": lambda raw, stg: sample_fidelity(sample_users(raw), raw),
    "csv_load": lambda raw, stg: _csv_load(raw),
    "raw_reload": lambda raw, stg: _raw_reload(raw),
    "daily_rebuild": lambda raw, stg: _daily_rebuild(raw),
    "partitioned_funnel": lambda raw, stg: _partitioned(funnel(stg), "funnel"),
    "partitioned_sessions": lambda raw, stg: _partitioned(sessionize(stg), "sessions"),
    "partitioned_cohort": lambda raw, stg: _partitioned(assign_cohorts(stg), "cohort"),
    "partitioned_retention": lambda raw, stg: _partitioned(retention(stg), "retention"),
    "snapshots": lambda raw, stg: _snapshots(stg, manifest=True),
    "snapshot_load": lambda raw, stg: _snapshots(stg, manifest=False),
    "sql_text": lambda raw, stg: _sql_text(stg),
    "sketched_actives": lambda raw, stg: _sketched_actives(stg),
    "rfm_scores": lambda raw, stg: segments.rfm_scores(stg),
    "rfm_segments": lambda raw, stg: segments.rfm_segments(stg),
    "bucketed_cohort_value": lambda raw, stg: _bucketed_cohort_value(stg),
}


def _check_suite(raw: DataFrame, stg: DataFrame) -> DataFrame:
    return run_checks({
        "events_raw": raw,
        "stg_events": stg,
        "sessions": sessionize(stg),
        "funnel": funnel(stg),
        "cohort": assign_cohorts(stg),
        "retention": retention(stg),
    })


def _csv_load(raw: DataFrame) -> DataFrame:
    """Out to CSV with the zone suffix, an extra column and another column order, and back."""
    return read_events_csv(raw.sparkSession, _csv_file(raw))


def _fresh_layers(raw: DataFrame) -> str:
    """A set of layers of its own with the events loaded from CSV; returns its prefix."""
    prefix = f"t{uuid.uuid4().hex[:12]}_"
    create_layers(raw.sparkSession, prefix)
    reload_raw_events(raw.sparkSession, _csv_file(raw), prefix)
    return prefix


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _raw_reload(raw: DataFrame) -> DataFrame:
    """The raw table after a load from CSV."""
    prefix = _fresh_layers(raw)
    try:
        return _written(raw.sparkSession.table(prefix + RAW_TABLE).drop("ingested_at"), "reloaded")
    finally:
        drop_layers(raw.sparkSession, prefix)


def _daily_rebuild(raw: DataFrame) -> DataFrame:
    """Load, staging view and marts as tables, then the outcome of all checks on them."""
    prefix = _fresh_layers(raw)
    try:
        build_marts(raw.sparkSession, prefix)
        return _written(check_layers(raw.sparkSession, prefix), "checked")
    finally:
        drop_layers(raw.sparkSession, prefix)


def _csv_file(raw: DataFrame) -> str:
    path = scratch_path(raw.sparkSession, "csv")
    stamped = F.concat(F.col("event_time").cast("string"), F.lit(" UTC")).alias("event_time")
    others = [c for c in reversed(RAW_EVENTS) if c != "event_time"]
    raw.select(F.lit("x").alias("extra"), *others, stamped).write.csv(
        path, header=True, escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return path


def _partitioned(table: DataFrame, name: str) -> DataFrame:
    spark = table.sparkSession
    path = scratch_path(spark, name)
    write_layout(_written(table, f"{name}_table"), name, path)
    return read_layout(spark, path)


def _snapshots(stg: DataFrame, manifest: bool) -> DataFrame:
    spark = stg.sparkSession
    path = scratch_path(spark, "snapshots")
    layers = {
        STAGING_VIEW: stg,
        TABLES["funnel"]: funnel(stg),
        TABLES["retention"]: retention(stg),
    }
    if not manifest:
        export_snapshots(layers, path, ["daily_activity"])
        return load_report(spark, "daily_activity", path, live=False)
    export_snapshots(layers, path)
    # File sizes differ from run to run.
    return snapshot_manifest(spark, path).drop("bytes")


def _sql_text(stg: DataFrame) -> DataFrame:
    stg.createOrReplaceTempView("stg_events")
    found = query(stg.sparkSession, """
        SELECT brand, event_type, count(*) AS events, count(DISTINCT user_id) AS users,
               min(event_at) AS first_at, max(price) AS top_price
        FROM stg_events GROUP BY brand, event_type
    """)
    # The query is resolved: a view left in the session would be listed with every schema.
    stg.sparkSession.catalog.dropTempView("stg_events")
    return found


def _sketched_actives(stg: DataFrame) -> DataFrame:
    """Exact actives of each period, and whether merged daily sketches come within four standard
    errors of them."""
    sketches = _written(daily_sketches(stg), "sketches")
    found = []
    for unit, period in PERIODS.items():
        exact = stg.groupBy(period(F.col("event_at")).alias("period")).agg(F.count_distinct("user_id").alias("users"))
        both = exact.join(active_users(sketches, unit), "period")
        found.append(both.select(F.lit(unit).alias("unit"), "period", "users", "active_users"))
    days, weeks, months = found
    within = F.abs(F.col("active_users") - F.col("users")) <= F.ceil(F.col("users") * (4 * relative_error()))
    return days.union(weeks).union(months).select("unit", "period", "users", within.alias("within"))


def _bucketed_cohort_value(stg: DataFrame) -> DataFrame:
    """Revenue by cohort over bucketed tables of sessions and cohorts, in a database that goes."""
    spark, database = stg.sparkSession, f"b{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        sessions = write_bucketed(sessionize(stg), f"{database}.sessions", buckets=BUCKETS_HERE)
        cohort = write_bucketed(assign_cohorts(stg), f"{database}.cohort", buckets=BUCKETS_HERE)
        return _written(loyalty.cohort_value(sessions, cohort), "cohort_value")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _bind(adapter: Callable, over: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = adapter(spark, sf_dir)
        return over(raw, stage_events(raw))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    bound = {}
    for suffix, adapter in ADAPTERS.items():
        over = dict(OVER_EVENTS)
        day = LOOKUP_DAY[suffix]
        over["day_lookup"] = lambda raw, stg, day=day: activity.day_lookup(stg, day)
        bound |= {name + suffix: _bind(adapter, q) for name, q in over.items()}
    return bound | CORPUS_QUERIES


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: user sessions of the events table."""
    return queries()["sessions"](spark, ENTRY_DIR)


# --- oracles -----------------------------------------------------------------------------

RAW_SQL = {
    "": """
        SELECT ts AS event_time,
               CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
               event_id % 500 AS product_id,
               k AS category_id,
               CASE WHEN k % 20 = 0 THEN '' ELSE concat(' cat.', k % 20) END AS category_code,
               CASE WHEN k % 7 = 0 THEN ' ' ELSE concat('brand_', k % 7) END AS brand,
               CAST(value AS DECIMAL(10, 2)) AS price,
               user_id,
               concat(user_id, '-', CAST(ts AS DATE)) AS user_session
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    """,
    "_orders": """
        SELECT o_orderdate AS event_time,
               CASE o_orderstatus WHEN 'O' THEN 'view' WHEN 'P' THEN 'cart'
                                  WHEN 'F' THEN 'purchase' END AS event_type,
               o_orderkey AS product_id,
               o_orderkey % 5 AS category_id,
               CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN ' '
                                    ELSE o_orderpriority END AS category_code,
               CAST(NULL AS VARCHAR) AS brand,
               CAST(o_totalprice AS DECIMAL(10, 2)) AS price,
               o_custkey AS user_id,
               concat(o_custkey, '-', CAST(o_orderdate AS DATE)) AS user_session
        FROM orders
    """,
}


def _half_up(num: str, den: str, places: int) -> str:
    """num / den for integers, rounded half away from zero, in integer arithmetic."""
    scale = 10**places
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"CASE WHEN {d} <> 0 THEN CAST(sign({n}) * "
        f"((2 * abs({n}) * {scale} + {d}) // (2 * {d})) AS DOUBLE) / {scale} END"
    )


def _share(num: str, den: str) -> str:
    return f"CASE WHEN {den} <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


LAYERS_SQL = f"""
    stg AS (
        SELECT event_time AS event_at, lower(trim(event_type)) AS event_type, product_id,
               category_id, nullif(trim(category_code), '') AS category_code,
               nullif(trim(brand), '') AS brand, price, user_id,
               nullif(trim(user_session), '') AS session_id,
               nullif(trim(user_session), '') AS user_session
        FROM raw
        WHERE event_type IN ('view', 'cart', 'purchase')
          AND event_time IS NOT NULL AND user_id IS NOT NULL
    ),
    waits AS (
        SELECT *, epoch_us(event_at) - lag(epoch_us(event_at)) OVER mine AS wait_us
        FROM stg WINDOW mine AS (PARTITION BY user_id ORDER BY event_at)
    ),
    visits AS (
        SELECT *, count(*) FILTER (WHERE wait_us IS NULL OR wait_us > 1800000000) OVER upto AS seq
        FROM waits WINDOW upto AS (PARTITION BY user_id ORDER BY event_at
                                   RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ),
    sessions AS (
        SELECT md5(concat(user_id, '-', seq)) AS session_key,
               user_id,
               seq AS session_seq,
               min(event_at) AS session_start,
               max(event_at) AS session_end,
               CAST(epoch_us(max(event_at)) - epoch_us(min(event_at)) AS DOUBLE) / 1000000 / 60
                   AS duration_minutes,
               count(*) AS total_events,
               count(*) FILTER (WHERE event_type = 'view') AS views,
               count(*) FILTER (WHERE event_type = 'cart') AS carts,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
               CAST(sum(CASE event_type WHEN 'purchase' THEN price ELSE 0 END) AS DECIMAL(20, 2))
                   AS revenue,
               bool_or(event_type = 'purchase') AS converted
        FROM visits GROUP BY user_id, seq
    ),
    cohort AS (
        SELECT user_id, min(event_at) AS first_event_at,
               CAST(date_trunc('week', min(event_at)) AS DATE) AS cohort_week,
               CAST(date_trunc('month', min(event_at)) AS DATE) AS cohort_month
        FROM stg GROUP BY user_id
    ),
    stage_users AS (
        SELECT count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS v,
               count(DISTINCT user_id) FILTER (WHERE event_type = 'cart') AS c,
               count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS p
        FROM stg
    ),
    funnel AS (
        SELECT 'view' AS stage, 1 AS stage_order, v AS users, v AS top, v AS prev,
               CAST(1 AS DOUBLE) AS pct_of_top, CAST(1 AS DOUBLE) AS pct_of_prev FROM stage_users
        UNION ALL
        SELECT 'cart', 2, c, v, v, {_share("c", "v")}, {_share("c", "v")} FROM stage_users
        UNION ALL
        SELECT 'purchase', 3, p, v, c, {_share("p", "v")}, {_share("p", "c")} FROM stage_users
    ),
    active AS (
        SELECT cohort_week, user_id,
               CAST(date_diff('day', cohort_week, CAST(event_at AS DATE)) // 7 AS INTEGER)
                   AS week_number
        FROM stg JOIN cohort USING (user_id)
    ),
    sizes AS (SELECT cohort_week, count(*) AS cohort_users FROM cohort GROUP BY cohort_week),
    retention AS (
        SELECT cohort_week, week_number, count(DISTINCT user_id) AS retained_users, cohort_users,
               {_half_up("count(DISTINCT user_id)", "cohort_users", 4)} AS retention_rate
        FROM active JOIN sizes USING (cohort_week)
        GROUP BY cohort_week, week_number, cohort_users
    ),
    daily AS (
        SELECT CAST(event_at AS DATE) AS day, count(DISTINCT user_id) AS dau,
               count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS buyers,
               count(*) AS events,
               CAST(coalesce(sum(price) FILTER (WHERE event_type = 'purchase'), 0)
                    AS DECIMAL(20, 2)) AS gmv
        FROM stg GROUP BY 1
    ),
    kpi AS (
        SELECT count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions,
               count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS buyers,
               CAST(coalesce(sum(price) FILTER (WHERE event_type = 'purchase'), 0)
                    AS DECIMAL(20, 2)) AS gmv,
               count(*) AS events
        FROM stg
    ),
    categories AS (
        SELECT coalesce(category_code, 'unknown') AS category, count(*) AS purchases,
               CAST(sum(price) AS DECIMAL(20, 2)) AS revenue, count(DISTINCT user_id) AS buyers
        FROM stg WHERE event_type = 'purchase' GROUP BY 1
    ),
    curve AS (
        SELECT week_number,
               CAST(sum(CAST(retention_rate AS DECIMAL(10, 4))) AS DOUBLE) / count(*)
                   AS retention_rate,
               CAST(sum(CAST(round(retention_rate * 10000) AS BIGINT)) AS BIGINT) AS rate_points,
               count(*) AS cohorts,
               CAST(sum(retained_users) AS BIGINT) AS total_retained
        FROM retention GROUP BY week_number
    )
"""

STG_COLUMNS = (
    "event_at, event_type, product_id, category_id, category_code, brand, price, user_id, "
    "session_id, user_session"
)
RETENTION_COLUMNS = "cohort_week, week_number, retained_users, cohort_users, retention_rate"
SAMPLED = "CAST(concat('0x', substring(md5(concat(user_id, ':42')), 1, 8)) AS BIGINT) % 10000 < 500"


def _check_sql() -> str:
    def missing(table: str, column: str, source: str) -> str:
        return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
                f"'not_null' AS check_name, count(*) AS failures FROM {source} WHERE {column} IS NULL")

    def repeated(table: str, column: str) -> str:
        return (f"SELECT '{table}', '{column}', 'unique', count(*) FROM (SELECT {column} FROM {table} "
                f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)")

    def unknown(table: str, column: str, source: str) -> str:
        return (f"SELECT '{table}', '{column}', 'accepted_values', count(DISTINCT {column}) "
                f"FROM {source} WHERE {column} NOT IN ('view', 'cart', 'purchase')")

    parts = [
        missing("events_raw", "user_id", "raw"),
        missing("events_raw", "event_type", "raw"),
        missing("events_raw", "event_time", "raw"),
        unknown("events_raw", "event_type", "raw"),
        missing("stg_events", "user_id", "stg"),
        missing("stg_events", "event_type", "stg"),
        missing("stg_events", "event_at", "stg"),
        unknown("stg_events", "event_type", "stg"),
        missing("sessions", "session_key", "sessions"),
        missing("sessions", "user_id", "sessions"),
        repeated("sessions", "session_key"),
        missing("funnel", "stage", "funnel"),
        unknown("funnel", "stage", "funnel"),
        missing("cohort", "user_id", "cohort"),
        repeated("cohort", "user_id"),
        missing("retention", "cohort_week", "retention"),
        missing("retention", "week_number", "retention"),
    ]
    return f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


def _pivot_sql(weeks: range, value: str, column: str) -> str:
    return ", ".join(
        f'max({value}) FILTER (WHERE week_number = {week}) AS "{column.format(week)}"'
        for week in weeks
    )


def _oracles(day: dt.date) -> dict[str, str]:
    retention_all = f"SELECT {RETENTION_COLUMNS} FROM retention"
    return {
        "stg_events": f"SELECT {STG_COLUMNS} FROM stg",
        "sessions": "SELECT * FROM sessions",
        "cohort": "SELECT * FROM cohort",
        "funnel": "SELECT stage, stage_order, users, pct_of_top, pct_of_prev FROM funnel",
        "retention": retention_all,
        "retention_from_cohort": retention_all,
        "funnel_dropoff": f"""
            SELECT stage, users, {_half_up("users * 100", "top", 2)} AS pct_of_top,
                   {_half_up("users * 100", "prev", 2)} AS pct_of_prev,
                   {_half_up("(prev - users) * 100", "prev", 2)} AS drop_off_pct
            FROM funnel""",
        "weekly_conversion": f"""
            SELECT week, viewers, buyers, {_half_up("buyers", "viewers", 4)} AS conversion_rate
            FROM (SELECT CAST(date_trunc('week', event_at) AS DATE) AS week,
                         count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS viewers,
                         count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS buyers
                  FROM stg GROUP BY 1)""",
        "top_categories_20": """
            SELECT category, purchases, revenue FROM categories
            ORDER BY revenue DESC NULLS FIRST, category LIMIT 20""",
        "headline_kpis": """
            SELECT users AS total_users, sessions AS total_sessions, events AS total_events,
                   buyers AS paying_users, gmv FROM kpi""",
        "dau": "SELECT day, dau FROM daily",
        "user_revenue": """
            SELECT user_id, CAST(sum(price) AS DECIMAL(20, 2)) AS revenue
            FROM stg WHERE event_type = 'purchase' GROUP BY user_id""",
        "session_averages": f"""
            SELECT {_half_up("sum(epoch_us(session_end) - epoch_us(session_start))", "count(*) * 60000000", 2)}
                       AS avg_session_minutes,
                   {_half_up("sum(total_events)", "count(*)", 2)} AS avg_events_per_session,
                   {_half_up("count(*) FILTER (WHERE converted) * 100", "count(*)", 2)}
                       AS session_conversion_pct
            FROM sessions""",
        "retention_curve": f"""
            SELECT week_number, {_half_up("rate_points", "cohorts * 100", 2)} AS avg_retention_pct,
                   total_retained FROM curve""",
        "retention_matrix": f"""
            SELECT cohort_week, cohort_users, {_pivot_sql(range(5), "retention_rate", "w{}")}
            FROM retention GROUP BY cohort_week, cohort_users""",
        "best_cohorts_w1": """
            SELECT cohort_week, cohort_users, retention_rate AS week_1_retention
            FROM retention WHERE week_number = 1
            ORDER BY retention_rate DESC NULLS FIRST, cohort_week LIMIT 10""",
        "kpi_summary": "SELECT * FROM kpi",
        "kpi_ratios": f"""
            SELECT coalesce({_share("buyers", "users")}, 0) * 100 AS conversion_pct,
                   coalesce({_share("gmv", "buyers")}, 0) AS arppu FROM kpi""",
        "funnel_stage_rates": """
            SELECT max(pct_of_prev) FILTER (WHERE stage = 'cart') * 100 AS view_to_cart_pct,
                   max(pct_of_prev) FILTER (WHERE stage = 'purchase') * 100 AS cart_to_purchase_pct,
                   max(pct_of_top) FILTER (WHERE stage = 'purchase') * 100 AS overall_pct
            FROM funnel""",
        "funnel_chart": """
            SELECT concat(upper(stage[1]), stage[2:]) AS stage_label, users, pct_of_top FROM funnel""",
        "retention_heatmap": "SELECT cohort_week, week_number, retention_rate * 100 AS pct FROM retention",
        "retention_curve_pct": """
            SELECT week_number, retention_rate, retention_rate * 100 AS retention_pct FROM curve""",
        "retention_drop_pp": """
            SELECT week_1_pct, week_2_pct, week_1_pct - week_2_pct AS drop_pp
            FROM (SELECT max(retention_rate * 100) FILTER (WHERE week_number = 1) AS week_1_pct,
                         max(retention_rate * 100) FILTER (WHERE week_number = 2) AS week_2_pct
                  FROM curve)
            WHERE week_1_pct <> 0 AND week_2_pct <> 0""",
        "daily_activity": "SELECT * FROM daily",
        "snapshot_load": "SELECT * FROM daily",
        "peak_days": """
            SELECT d.day AS peak_dau_day, strftime(d.day, '%b %d') AS peak_dau_label,
                   d.dau AS peak_dau, g.day AS peak_gmv_day,
                   strftime(g.day, '%b %d') AS peak_gmv_label, g.gmv AS peak_gmv
            FROM (SELECT * FROM daily ORDER BY dau DESC, day LIMIT 1) d,
                 (SELECT * FROM daily ORDER BY gmv DESC, day LIMIT 1) g""",
        "day_lookup": f"SELECT day, dau FROM daily WHERE day = DATE '{day}'",
        "top_categories_15": f"""
            SELECT *, {_share("revenue", "purchases")} AS aov FROM categories
            ORDER BY revenue DESC NULLS FIRST, category LIMIT 15""",
        "check_not_null": f"SELECT {STG_COLUMNS} FROM stg WHERE category_code IS NULL",
        "check_unique": """
            SELECT user_session, count(*) AS n_records FROM stg
            WHERE user_session IS NOT NULL GROUP BY user_session HAVING count(*) > 1""",
        "check_accepted_values": """
            SELECT event_type, count(*) AS n_records FROM raw
            WHERE event_type NOT IN ('view', 'cart') GROUP BY event_type""",
        "check_suite": _check_sql(),
        "user_sample": f"SELECT * FROM raw WHERE {SAMPLED}",
        "sample_fidelity": f"""
            SELECT *, abs(sample_share - full_share) AS share_gap
            FROM (SELECT event_type, full_events, sample_events,
                         {_share("full_events", "sum(full_events) OVER ()")} AS full_share,
                         {_share("sample_events", "sum(sample_events) OVER ()")} AS sample_share
                  FROM (SELECT event_type, count(*) AS full_events,
                               count(*) FILTER (WHERE {SAMPLED}) AS sample_events
                        FROM raw GROUP BY event_type))""",
        "csv_load": """
            SELECT event_time, event_type, product_id, category_id,
                   nullif(category_code, '') AS category_code, brand, price, user_id, user_session
            FROM raw""",
        "raw_reload": """
            SELECT event_time, event_type, product_id, category_id,
                   nullif(category_code, '') AS category_code, brand, price, user_id, user_session
            FROM raw""",
        "daily_rebuild": _check_sql(),
        "partitioned_funnel": "SELECT stage, stage_order, users, pct_of_top, pct_of_prev FROM funnel",
        "partitioned_sessions": "SELECT *, CAST(session_start AS DATE) AS session_date FROM sessions",
        "partitioned_cohort": "SELECT * FROM cohort",
        "partitioned_retention": retention_all,
        "snapshots": """
            SELECT coalesce(snapshot, 'total') AS snapshot, CAST(sum(n) AS BIGINT) AS rows
            FROM (SELECT 'kpi_summary' AS snapshot, count(*) AS n FROM kpi
                  UNION ALL SELECT 'funnel', count(*) FROM funnel
                  UNION ALL SELECT 'retention', count(*) FROM retention
                  UNION ALL SELECT 'daily_activity', count(*) FROM daily
                  UNION ALL SELECT 'top_categories', least(15, count(*)) FROM categories)
            GROUP BY ROLLUP (snapshot)""",
        "sql_text": """
            SELECT brand, event_type, count(*) AS events, count(DISTINCT user_id) AS users,
                   min(event_at) AS first_at, max(price) AS top_price
            FROM stg GROUP BY brand, event_type""",
        "sketched_actives": " UNION ALL ".join(
            f"""SELECT '{unit}' AS unit, CAST(date_trunc('{unit}', event_at) AS DATE) AS period,
                       count(DISTINCT user_id) AS users, true AS within
                FROM stg GROUP BY 2""" for unit in ("day", "week", "month")
        ),
        "rfm_scores": RFM_SQL,
        "rfm_segments": f"""
            SELECT segment, count(*) AS buyers, CAST(sum(orders) AS BIGINT) AS orders,
                   CAST(sum(spent) AS DECIMAL(20, 2)) AS revenue
            FROM ({RFM_SQL}) GROUP BY segment""",
        "bucketed_cohort_value": """
            SELECT c.cohort_month, count(DISTINCT s.user_id) AS users, count(*) AS sessions,
                   count(*) FILTER (WHERE s.converted) AS converted,
                   CAST(sum(s.revenue) AS DECIMAL(20, 2)) AS revenue
            FROM sessions s JOIN cohort c ON c.user_id = s.user_id GROUP BY c.cohort_month""",
    }


def _three_digits(number: str) -> str:
    return (
        f"CASE WHEN {number} < 1000 THEN {number} ELSE {number} // "
        f"CAST(pow(10, length(CAST({number} AS VARCHAR)) - 3) AS BIGINT) * CAST(pow(10, length(CAST({number} AS VARCHAR)) - 3) AS BIGINT) END"
    )


def _fifth(by: str) -> str:
    return f"CAST(1 + 5 * (rank() OVER (ORDER BY {by}) - 1) // count(*) OVER () AS INTEGER)"


RFM_SQL = f"""
    SELECT *, CASE WHEN recency >= 4 AND frequency >= 4 THEN 'champions' WHEN frequency >= 4 THEN 'loyal'
                   WHEN recency >= 4 THEN 'recent' WHEN recency > 2 THEN 'steady'
                   WHEN frequency <= 2 THEN 'lost' ELSE 'at risk' END AS segment
    FROM (SELECT user_id, last_day, orders, CAST(spent AS DECIMAL(20, 2)) AS spent,
                 {_fifth("last_day")} AS recency, {_fifth(_three_digits("orders"))} AS frequency,
                 {_fifth(_three_digits("CAST(greatest(spent, 0) * 100 AS BIGINT)"))} AS money
          FROM (SELECT user_id, max(CAST(event_at AS DATE)) AS last_day, count(*) AS orders,
                       coalesce(sum(price), 0) AS spent
                FROM stg WHERE event_type = 'purchase' GROUP BY user_id))
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the keys of ``queries()`` that SQL can express."""
    return CORPUS_SQL | {
        name + suffix: f"WITH raw AS ({raw}), {LAYERS_SQL} {body}"
        for suffix, raw in RAW_SQL.items()
        for name, body in _oracles(LOOKUP_DAY[suffix]).items()
    }
