"""Sketched actives, buyer segments and bucketed tables."""

import datetime as dt
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from footfall.operators import active_users, assign_cohorts, daily_sketches, relative_error, sessionize, stage_events
from footfall.plans import loyalty, segments
from footfall.sources import orders_as_clicks, write_bucketed


@pytest.fixture(scope="module")
def clicks(spark):
    """200,000 events of 60,000 users over 60 days, a third of them of one user."""
    user = F.when(F.col("id") % 3 == 0, 0).otherwise(F.xxhash64("id") % 30_000)
    at = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 60 AS INT))")
    return spark.range(200_000).select(user.alias("user_id"), at.alias("event_at"))


@pytest.mark.parametrize("unit", ["day", "week", "month"])
def test_merged_sketches_come_near_the_exact_count(spark, clicks, unit):
    exact = clicks.groupBy(F.date_trunc(unit, "event_at").cast("date").alias("period")).agg(F.count_distinct("user_id").alias("n"))
    want = {r.period: r.n for r in exact.collect()}
    got = {r.period: r.active_users for r in active_users(daily_sketches(clicks), unit).collect()}
    assert set(got) == set(want)
    assert all(abs(got[p] - n) <= 4 * relative_error() * n for p, n in want.items())


def test_sketches_of_few_users_are_exact(staged, rows):
    events = staged((1, "2024-01-01 23:00:00", "view"), (1, "2024-01-02 01:00:00", "view"), (2, "2024-01-02 02:00:00", "cart"), (None, "2024-01-09 00:00:00", "cart"))
    sketches = daily_sketches(events)
    week, next_week = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    assert rows(active_users(sketches, "week")) == [(week, 2), (next_week, 0)]
    assert rows(active_users(daily_sketches(staged()), "month")) == []


def test_segments_of_nothing_and_of_one(staged, rows):
    assert rows(segments.rfm_scores(staged((1, "2024-01-01 00:00:00", "view", 3), (None, "2024-01-01 00:00:00", "purchase", 3)))) == []
    got = rows(segments.rfm_scores(staged((1, "2024-01-01 00:00:00", "purchase"), (1, "2024-01-03 00:00:00", "purchase"))))
    assert got == [(1, dt.date(2024, 1, 3), 2, D("0.00"), 1, 1, 1, "lost")]


def test_scores_of_ten_buyers(staged, rows):
    """Fifths of ten, ties alike, money beyond three digits and below 0."""
    prices = [-5, 0, 1, 2, 3, "1234.50", "1234.70", 20000, 20000, "0.50"]
    events = staged(*[(u, f"2024-01-{10 + u} 00:00:00", "purchase", p) for u, p in enumerate(prices)])
    got = {r.user_id: r for r in segments.rfm_scores(events).collect()}
    assert [got[u].recency for u in range(10)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert {r.frequency for r in got.values()} == {1}
    assert [got[u].money for u in range(10)] == [1, 1, 2, 3, 3, 4, 4, 5, 5, 2]
    summary = rows(segments.rfm_segments(events), "segment", "buyers")
    assert summary == [("lost", 4), ("recent", 4), ("steady", 2)]


def test_events_are_folded_to_buyers_once(spark):
    """As it ran: scores come from counts per value, and events are read and shuffled once for
    both branches; nothing is sorted over all buyers."""
    found = segments.rfm_scores(stage_events(orders_as_clicks(spark, "/root/testdata/sf0.001")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_bucketed_tables_join_without_a_shuffle(spark, staged):
    events = staged(*[(u % 40, f"2024-0{1 + u % 3}-01 0{u % 9}:00:00", "purchase", u) for u in range(200)])
    database = f"b{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plain = loyalty.cohort_value(sessionize(events), assign_cohorts(events))
        sessions = write_bucketed(sessionize(events), f"{database}.sessions", buckets=4)
        cohort = write_bucketed(assign_cohorts(events), f"{database}.cohort", buckets=4)
        got = loyalty.cohort_value(sessions, cohort)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(user_id" not in plan and "SortMergeJoin" in plan
        assert "Exchange hashpartitioning(user_id" in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(got.collect()) == sorted(plain.collect())
        # Replaced in place by other rows.
        assert write_bucketed(assign_cohorts(events.limit(0)), f"{database}.cohort", buckets=4).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP DATABASE {database} CASCADE")
