"""Reports: zero guards, NULL order, ties, rounding."""

import datetime as dt
from decimal import Decimal as D

import pytest

from footfall.plans import activity, conversion, loyalty

DAY = "2024-01-01 10:00:00"


@pytest.fixture(scope="module")
def retained(spark):
    def build(*cells):
        """(cohort_week, week_number, retained_users, cohort_users, rate)"""
        return spark.createDataFrame(
            [(dt.date.fromisoformat(c[0]), *c[1:]) for c in cells],
            "cohort_week date, week_number int, retained_users bigint, cohort_users bigint, "
            "retention_rate double",
        )

    return build


def test_kpis_of_nothing(staged, rows):
    assert rows(activity.kpi_summary(staged())) == [(0, 0, 0, D("0.00"), 0)]
    assert rows(activity.headline_kpis(staged())) == [(0, 0, 0, 0, D("0.00"))]
    assert rows(activity.kpi_ratios(staged())) == [(0.0, 0.0)]
    assert rows(activity.daily_activity(staged())) == []
    assert rows(activity.peak_days(staged())) == []


def test_kpis(staged, rows):
    """A session id shared by two users is one session; a missing one is none."""
    events = staged(
        (1, DAY, "view", 5, None, "a"), (1, DAY, "purchase", 5, None, "a"), (1, DAY, "purchase", None, None, "b"),
        (2, DAY, "view", 1, None, "a"), (3, DAY, "purchase", "2.50", None, None), (4, DAY, "cart", 1, None, None),
    )
    assert rows(activity.kpi_summary(events)) == [(4, 2, 2, D("7.50"), 6)]
    assert rows(activity.kpi_ratios(events)) == [(50.0, 3.75)]


def test_kpi_ratios_without_buyers(staged, rows):
    assert rows(activity.kpi_ratios(staged((1, DAY, "view", 5)))) == [(0.0, 0.0)]


def test_daily_activity_and_peaks(staged, rows):
    events = staged(
        (1, "2024-01-02 00:00:00", "view"), (2, "2024-01-02 23:59:59", "purchase", 3),
        (1, "2024-01-05 00:00:00", "view"), (2, "2024-01-05 00:00:00", "view"), (2, "2024-01-05 01:00:00", "cart"),
        (1, "2024-01-09 00:00:00", "purchase", 3),
    )
    assert rows(activity.daily_activity(events)) == [
        (dt.date(2024, 1, 2), 2, 1, 2, D("3.00")), (dt.date(2024, 1, 5), 2, 0, 3, D("0.00")),
        (dt.date(2024, 1, 9), 1, 1, 1, D("3.00"))]
    second = dt.date(2024, 1, 2)
    assert rows(activity.peak_days(events)) == [(second, "Jan 02", 2, second, "Jan 02", D("3.00"))]
    assert rows(activity.day_lookup(events, dt.date(2024, 1, 5))) == [(dt.date(2024, 1, 5), 2)]
    assert rows(activity.day_lookup(events, dt.date(2024, 1, 6))) == []


def test_day_lookup_reaches_the_scan(spark):
    from footfall.operators import stage_events
    from footfall.sources import events_as_clicks

    events = stage_events(events_as_clicks(spark, "/root/testdata/sf0.001"))
    plan = activity.day_lookup(events, dt.date(2024, 1, 15))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00" in plan and "LessThan(ts,2024-01-" in plan


def test_unknown_users_are_not_counted(staged, rows):
    events = staged((None, DAY, "purchase", 5), (None, DAY, "view"), (1, DAY, "view"))
    assert rows(activity.kpi_summary(events)) == [(1, 0, 0, D("5.00"), 3)]
    assert rows(activity.daily_activity(events)) == [(dt.date(2024, 1, 1), 1, 0, 3, D("5.00"))]
    assert rows(activity.weekly_conversion(events)) == [(dt.date(2024, 1, 1), 1, 0, 0.0)]


def test_weekly_conversion(staged, rows):
    events = staged(
        *[(u, "2024-01-01 00:00:00", "view") for u in range(32)], (1, "2024-01-07 00:00:00", "purchase"),
        (1, "2024-01-08 00:00:00", "purchase"),
    )
    assert rows(activity.weekly_conversion(events)) == [
        (dt.date(2024, 1, 1), 32, 1, 0.0313), (dt.date(2024, 1, 8), 0, 1, None)]


def test_user_revenue_order(staged):
    events = staged((1, DAY, "purchase", 5), (2, DAY, "purchase"), (3, DAY, "purchase", 9),
                    (4, DAY, "purchase", 5), (5, DAY, "view", 100))
    assert [tuple(r) for r in activity.user_revenue(events).collect()] == [
        (2, None), (3, D("9.00")), (1, D("5.00")), (4, D("5.00"))]


def test_top_categories(staged):
    events = staged((1, DAY, "purchase", 5, "a"), (1, DAY, "purchase", None, "a"), (2, DAY, "purchase", 5, "b"),
                    (2, DAY, "purchase", None, "c"), (3, DAY, "purchase", 1), (3, DAY, "view", 99, "z"))
    assert [tuple(r) for r in activity.top_categories(events, 3).collect()] == [
        ("c", 1, None), ("a", 2, D("5.00")), ("b", 1, D("5.00"))]
    assert [tuple(r) for r in activity.top_category_buyers(events, 4).collect()] == [
        ("c", 1, None, 1, None), ("a", 2, D("5.00"), 1, 2.5), ("b", 1, D("5.00"), 1, 5.0),
        ("unknown", 1, D("1.00"), 1, 1.0)]


def test_session_averages(staged, rows):
    from footfall.operators import sessionize

    events = staged((1, "2024-01-01 00:00:00", "view"), (1, "2024-01-01 00:00:00.3", "view"),
                    (2, DAY, "purchase", 1), (3, DAY, "view"))
    # 0.3 s over three sessions: 0.001666.. minutes
    assert rows(activity.session_averages(sessionize(events))) == [(0.0, 1.33, 33.33)]
    assert rows(activity.session_averages(sessionize(staged()))) == [(None, None, None)]


def test_funnel_reports(spark, rows):
    funnel = spark.createDataFrame(
        [("view", 1, 800, 1.0, 1.0), ("cart", 2, 1, 0.00125, 0.00125), ("purchase", 3, 2, 0.0025, 2.0)],
        "stage string, stage_order int, users bigint, pct_of_top double, pct_of_prev double",
    )
    assert [tuple(r) for r in conversion.funnel_dropoff(funnel).collect()] == [
        ("view", 800, 100.0, 100.0, 0.0), ("cart", 1, 0.13, 0.13, 99.88), ("purchase", 2, 0.25, 200.0, -100.0)]
    assert rows(conversion.funnel_stage_rates(funnel)) == [(0.125, 200.0, 0.25)]
    assert [r.stage_label for r in conversion.funnel_chart(funnel).collect()] == ["View", "Cart", "Purchase"]


def test_retention_reports_skip_absent_weeks(retained, rows):
    cells = retained(("2024-01-01", 0, 4, 4, 1.0), ("2024-01-01", 1, 1, 4, 0.25), ("2024-01-08", 0, 8, 8, 1.0),
                     ("2024-01-08", 2, 4, 8, 0.5), ("2024-01-15", 1, 3, 4, 0.75))
    assert rows(loyalty.retention_curve(cells)) == [(0, 100.0, 12), (1, 50.0, 4), (2, 50.0, 4)]
    assert rows(loyalty.retention_curve_pct(cells)) == [(0, 1.0, 100.0), (1, 0.5, 50.0), (2, 0.5, 50.0)]
    first, second, third = dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 1, 15)
    matrix = loyalty.retention_matrix(cells)
    assert matrix.columns == ["cohort_week", "cohort_users", "w0", "w1", "w2", "w3", "w4"]
    assert rows(matrix) == [(first, 4, 1.0, 0.25, None, None, None), (second, 8, 1.0, None, 0.5, None, None),
                            (third, 4, None, 0.75, None, None, None)]
    heat = loyalty.retention_heatmap(cells)
    assert heat.columns == ["cohort_week", "0", "1", "2"]
    assert rows(heat) == rows(loyalty.retention_heatmap(cells, [0, 1, 2])) == [
        (first, 100.0, 25.0, None), (second, 100.0, None, 50.0), (third, None, 75.0, None)]
    assert rows(loyalty.best_cohorts(cells)) == [(first, 4, 0.25), (third, 4, 0.75)]
    assert [r.cohort_week for r in loyalty.best_cohorts(cells, k=1).collect()] == [third]
    assert rows(loyalty.retention_drop_pp(cells)) == [(50.0, 50.0, 0.0)]


def test_retention_drop_needs_both_weeks(retained, rows):
    assert rows(loyalty.retention_drop_pp(retained(("2024-01-01", 1, 1, 4, 0.25)))) == []
    zero = retained(("2024-01-01", 1, 1, 4, 0.25), ("2024-01-01", 2, 0, 4, 0.0))
    assert rows(loyalty.retention_drop_pp(zero)) == []
    two = retained(("2024-01-01", 1, 1, 4, 0.5), ("2024-01-01", 2, 0, 4, 0.25))
    assert rows(loyalty.retention_drop_pp(two)) == [(50.0, 25.0, 25.0)]


def test_curve_rounds_halves_up(retained, rows):
    """Mean 0.00025: half a hundredth of a percent rounds away from zero."""
    cells = retained(("2024-01-01", 1, 1, 1, 0.0002), ("2024-01-08", 1, 1, 1, 0.0003))
    assert rows(loyalty.retention_curve(cells), "avg_retention_pct") == [(0.03,)]


def test_heatmap_has_every_week_that_occurs(staged, rows):
    from footfall.operators import retention

    cells = loyalty.heatmap_cells(retention(staged(
        (1, "2024-01-01 10:00:00", "view"), (1, "2024-03-05 10:00:00", "view"), (2, "2024-01-01 10:00:00", "view"))))
    assert rows(cells) == [(dt.date(2024, 1, 1), 0, 100.0), (dt.date(2024, 1, 1), 9, 50.0)]
