"""Sessions against brute force, ties, exact gaps, hot users, and the plan."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.operators import sessionize
from footfall.schema import SESSIONS

T0 = dt.datetime(2024, 3, 10, 0, 0)


def brute_force(events, gap=dt.timedelta(minutes=30)):
    """Events (user, time, type, price) -> {(user, seq): session} by a plain loop."""
    sessions, last = {}, {}
    for user, at, kind, price in sorted(events, key=lambda e: (e[0], e[1])):
        seq = last[user][0] if user in last else 0
        if user not in last or at - last[user][1] > gap:
            seq += 1
        last[user] = (seq, at)
        sessions.setdefault((user, seq), []).append((at, kind, price))
    out = {}
    for key, group in sessions.items():
        times = [at for at, _, _ in group]
        money = [p if kind == "purchase" else Decimal(0) for _, kind, p in group]
        known = [m for m in money if m is not None]
        kinds = [kind for _, kind, _ in group]
        out[key] = (
            min(times), max(times), len(group), kinds.count("view"), kinds.count("cart"),
            kinds.count("purchase"), sum(known) if known else None, "purchase" in kinds,
        )
    return out


def result(df):
    return {
        (r.user_id, r.session_seq): (
            r.session_start, r.session_end, r.total_events, r.views, r.carts, r.purchases,
            r.revenue, r.converted,
        )
        for r in df.collect()
    }


def test_gap_is_strict_to_the_microsecond(staged, rows):
    at = T0 + dt.timedelta(minutes=7)
    merged = at + dt.timedelta(minutes=30)
    split = merged + dt.timedelta(minutes=30, microseconds=1)
    got = sessionize(staged((1, at, "view"), (1, merged, "view"), (1, split, "cart")))
    assert rows(got, "session_seq", "total_events", "duration_minutes") == [(1, 2, 30.0), (2, 1, 0.0)]


def test_gap_at_a_slot_edge(staged, rows):
    """Neighbouring slots can be nearly two gaps apart; slots are no sessions."""
    got = sessionize(staged(
        (1, "2024-01-01 00:00:00", "view"), (1, "2024-01-01 00:59:59.999999", "view"),
        (2, "2024-01-01 00:29:59.999999", "view"), (2, "2024-01-01 00:30:00", "view"),
        (3, "2024-01-01 00:29:00", "view"), (3, "2024-01-01 00:59:00.000001", "view"),
    ))
    assert rows(got, "user_id", "session_seq", "total_events") == [
        (1, 1, 1), (1, 2, 1), (2, 1, 2), (3, 1, 1), (3, 2, 1)
    ]


def test_ties_at_a_session_start_are_one_session(staged, rows):
    late = "2024-01-01 05:00:00"
    got = sessionize(staged((1, "2024-01-01 00:00:00", "view"), (1, late, "cart"), (1, late, "purchase", 5)))
    assert rows(got, "session_seq", "total_events", "converted") == [(1, 1, False), (2, 2, True)]


def test_revenue_of_unpriced_purchases(staged, rows):
    got = sessionize(staged(
        (1, "2024-01-01 00:00:00", "purchase"),                                          # NULL
        (2, "2024-01-01 00:00:00", "purchase"), (2, "2024-01-01 00:01:00", "view", 9),   # 0
        (3, "2024-01-01 00:00:00", "purchase"), (3, "2024-01-01 00:31:00", "purchase", "2.50"),
        (4, "2024-01-01 00:29:00", "purchase"), (4, "2024-01-01 00:31:00", "purchase", "2.50"),
    ))
    assert rows(got, "user_id", "session_seq", "revenue") == [
        (1, 1, None), (2, 1, Decimal("0.00")), (3, 1, None), (3, 2, Decimal("2.50")),
        (4, 1, Decimal("2.50")),
    ]


def test_before_1970(staged, rows):
    got = sessionize(staged(
        (1, "1969-12-31 23:40:00", "view"), (1, "1970-01-01 00:05:00", "view"),
        (1, "1960-01-01 00:00:00", "view"),
    ))
    assert rows(got, "session_seq", "total_events") == [(1, 1), (2, 2)]


@pytest.mark.parametrize("minutes", [1, 30, 1440])
def test_hot_user_equals_brute_force(spark, staged, minutes):
    """One user holds a third of the events; many ties, exact gaps and slot edges."""
    rng = random.Random(minutes)
    gap = dt.timedelta(minutes=minutes)
    steps = [dt.timedelta(0), gap, gap + dt.timedelta(microseconds=1), gap / 2, gap * 3,
             gap - dt.timedelta(microseconds=1), dt.timedelta(seconds=1)]
    events = []
    for user, n in [(0, 400)] + [(u, 20) for u in range(1, 41)]:
        at = T0
        for _ in range(n):
            at += rng.choice(steps)
            kind = rng.choice(["view", "cart", "purchase"])
            price = rng.choice([None, Decimal("1.10"), Decimal("20.05")])
            events.append((user, at, kind, price))
    rng.shuffle(events)
    got = sessionize(staged(*events), f"{minutes} minutes")
    assert result(got) == brute_force(events, gap)


def test_equals_session_window(staged):
    """Spark's own session windows close a gap early by nothing: a 30 min gap still merges."""
    rng = random.Random(7)
    events = staged(*[
        (rng.randrange(5), T0 + dt.timedelta(seconds=rng.randrange(400_000)), "view") for _ in range(500)
    ])
    ours = sessionize(events).select("user_id", "session_start", "total_events")
    theirs = events.groupBy("user_id", F.session_window("event_at", "30 minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("total_events")
    ).select("user_id", F.col("w.start").alias("session_start"), "total_events")
    assert ours.exceptAll(theirs).count() == theirs.exceptAll(ours).count() == 0


def test_result_does_not_depend_on_the_session_time_zone(spark, staged):
    """2024-03-10 02:30 does not exist in New York; zone-less times must not notice."""
    events = staged((1, "2024-03-10 01:50:00", "view"), (1, "2024-03-10 02:15:00", "view"),
                    (1, "2024-03-10 03:05:00", "view"))
    want = [tuple(r) for r in sessionize(events).collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [tuple(r) for r in sessionize(events).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(want) == 2


def test_invariants(spark, staged, rows):
    from footfall.operators import stage_events
    from footfall.sources import orders_as_clicks

    events = stage_events(orders_as_clicks(spark, "/root/testdata/sf0.001"))
    sessions = sessionize(events)
    assert dict(sessions.dtypes) == SESSIONS
    total, keys, n, backwards = sessions.agg(
        F.sum("total_events"), F.countDistinct("session_key"), F.count(F.lit(1)),
        F.count_if(F.col("session_end") < F.col("session_start")),
    ).first()
    assert total == events.count() and keys == n and backwards == 0
    w = Window.partitionBy("user_id").orderBy("session_seq")
    silences = sessions.select((F.col("session_start") - F.lag("session_end").over(w)).alias("silence"))
    assert silences.where("silence <= INTERVAL '30 minutes'").count() == 0


def test_windows_see_slots_not_events(spark, staged):
    """However many events a user sends, the window functions get one row per slot."""
    many = spark.range(20_000).select(
        F.lit(1).cast("bigint").alias("user_id"),
        (F.timestamp_seconds((F.col("id") % 7200) + 1_704_067_200)).cast("timestamp_ntz").alias("event_at"),
        F.lit("view").alias("event_type"),
        F.lit(None).cast("decimal(10,2)").alias("price"),
    )
    df = sessionize(many)
    assert [r.total_events for r in df.collect()] == [20_000]
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    below_window = text[text.rindex("Window ["):]
    assert below_window.count("HashAggregate") >= 2
    assert text.count("Exchange hashpartitioning") == 2
