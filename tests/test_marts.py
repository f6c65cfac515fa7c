"""Staging, cohorts, funnel and retention on literal rows."""

import datetime as dt
from decimal import Decimal

import pytest

from footfall.operators import assign_cohorts, first_touch, funnel, retention, stage_events
from footfall.schema import COHORT, FUNNEL, RAW_EVENTS, RETENTION, STG_EVENTS

DAY = "2024-01-01 10:00:00"


def test_staging_keeps_exact_types_only(raw, rows):
    events = raw(
        {"user_id": 1, "event_time": DAY, "event_type": "view"},
        {"user_id": 2, "event_time": DAY, "event_type": "VIEW"},
        {"user_id": 3, "event_time": DAY, "event_type": " view"},
        {"user_id": 4, "event_time": DAY},
        {"user_id": 5, "event_type": "cart"},
        {"event_time": DAY, "event_type": "cart"},
        {"user_id": 7, "event_time": DAY, "event_type": "purchase"},
    )
    assert rows(stage_events(events), "user_id") == [(1,), (7,)]


def test_staging_cleans_text_and_keeps_duplicates(raw, rows):
    one = {"user_id": 1, "event_time": DAY, "event_type": "view", "category_code": " a.b ",
           "brand": "  ", "user_session": "", "price": "1.255"}
    staged = stage_events(raw(one, one))
    assert dict(staged.dtypes) == STG_EVENTS
    assert rows(staged, "category_code", "brand", "session_id", "user_session", "price") == [
        ("a.b", None, None, None, Decimal("1.26"))] * 2


def test_staging_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    schema = ", ".join(f"{c} {t}" for c, t in RAW_EVENTS.items())
    spark.createDataFrame([], schema).write.parquet(path)
    plan = assign_cohorts(stage_events(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    assert "In(event_type, [cart,purchase,view])" in plan
    assert "IsNotNull(event_time)" in plan and "IsNotNull(user_id)" in plan
    assert "ReadSchema: struct<event_time:timestamp_ntz,event_type:string,user_id:bigint>" in plan


def test_cohort_weeks_start_on_monday(staged, rows):
    got = assign_cohorts(staged(
        (1, "2024-01-07 23:59:59", "view"), (2, "2024-01-08 00:00:00", "view"),
        (2, "2024-02-08 00:00:00", "view"),
    ))
    assert dict(got.dtypes) == COHORT
    assert rows(got, "user_id", "cohort_week", "cohort_month") == [
        (1, dt.date(2024, 1, 1), dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 8), dt.date(2024, 1, 1))]


def test_funnel_ignores_order_in_time(staged, rows):
    events = staged((1, DAY, "purchase"), (2, DAY, "view"), (2, "2023-01-01 00:00:00", "cart"),
                    (3, DAY, "purchase"), (3, DAY, "view"))
    got = funnel(events)
    assert dict(got.dtypes) == FUNNEL
    assert rows(got) == [("cart", 2, 1, 0.5, 0.5), ("purchase", 3, 2, 1.0, 2.0), ("view", 1, 2, 1.0, 1.0)]
    touched = first_touch(events).where("user_id = 2").first()
    assert touched.first_cart_at == dt.datetime(2023, 1, 1) and touched.first_purchase_at is None


def test_funnel_without_viewers(staged, rows):
    got = funnel(staged((1, DAY, "cart"), (2, DAY, "cart"), (2, DAY, "purchase")))
    assert rows(got) == [("cart", 2, 2, None, None), ("purchase", 3, 1, None, 0.5), ("view", 1, 0, 1.0, 1.0)]


def test_funnel_of_nothing(staged, rows):
    assert rows(funnel(staged())) == [
        ("cart", 2, None, None, None), ("purchase", 3, None, None, None), ("view", 1, None, 1.0, 1.0)]


def test_retention_both_forms(staged, rows):
    events = staged(
        (1, "2024-01-01 00:00:00", "view"), (1, "2024-01-02 00:00:00", "view"),
        (1, "2024-01-22 00:00:00", "view"),
        (2, "2024-01-07 23:59:59", "view"), (2, "2024-01-08 00:00:00", "view"),
        (3, "2024-01-03 00:00:00", "view"),
        (4, "2024-01-15 00:00:00", "view"),
    )
    monday, third = dt.date(2024, 1, 1), dt.date(2024, 1, 15)
    want = [(monday, 0, 3, 3, 1.0), (monday, 1, 1, 3, 0.3333), (monday, 3, 1, 3, 0.3333),
            (third, 0, 1, 1, 1.0)]
    direct, joined = retention(events), retention(events, assign_cohorts(events))
    assert dict(direct.dtypes) == dict(joined.dtypes) == RETENTION
    assert rows(direct) == rows(joined) == want


def test_retention_follows_the_given_cohort(staged, spark, rows):
    """Activity before the cohort week is left out, and so are users without a cohort."""
    events = staged((1, "2024-01-01 00:00:00", "view"), (1, "2024-01-15 00:00:00", "view"),
                    (2, "2024-01-15 00:00:00", "view"))
    cohort = spark.sql("SELECT 1L AS user_id, DATE '2024-01-08' AS cohort_week UNION ALL "
                       "SELECT 9L, DATE '2024-01-08'")
    assert rows(retention(events, cohort)) == [(dt.date(2024, 1, 8), 1, 1, 2, 0.5)]


@pytest.mark.parametrize("adapter", ["events_as_clicks", "orders_as_clicks"])
def test_retention_invariants(spark, adapter):
    from footfall import sources

    events = stage_events(getattr(sources, adapter)(spark, "/root/testdata/sf0.001"))
    got = retention(events)
    bad = got.where("retention_rate NOT BETWEEN 0 AND 1 OR (week_number = 0 AND retained_users <> cohort_users)")
    assert bad.count() == 0
    assert got.where("week_number = 0").count() == got.select("cohort_week").distinct().count()
