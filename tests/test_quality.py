"""Data-quality checks and sampling on deliberately dirty rows."""

import pytest

from footfall.operators import (
    CHECKS,
    Check,
    accepted_values,
    not_null,
    require_passing,
    run_checks,
    sample_fidelity,
    sample_users,
    unique,
)

DAY = "2024-01-01 10:00:00"


@pytest.fixture(scope="module")
def dirty(raw):
    return raw(
        {"user_id": 1, "event_time": DAY, "event_type": "view"},
        {"user_id": 1, "event_time": DAY, "event_type": "remove"},
        {"user_id": 1, "event_time": DAY, "event_type": "remove"},
        {"user_id": 2, "event_time": DAY, "event_type": "VIEW"},
        {"user_id": 2, "event_type": "cart"},
        {"event_time": DAY},
        {"event_time": DAY},
    )


def test_single_checks(dirty, rows):
    assert not_null(dirty, "user_id").count() == 2
    assert rows(unique(dirty, "user_id")) == [(1, 3), (2, 2)]
    assert rows(accepted_values(dirty, "event_type", ["view", "cart"])) == [("VIEW", 1), ("remove", 2)]


def test_suite(dirty, rows):
    checks = [c for c in CHECKS if c.table == "events_raw"] + [Check("events_raw", "user_id", "unique")]
    got = run_checks({"events_raw": dirty}, checks)
    assert rows(got, "column_name", "check_name", "failures", "passed") == [
        ("event_time", "not_null", 1, False),
        ("event_type", "accepted_values", 2, False),
        ("event_type", "not_null", 2, False),
        ("user_id", "not_null", 2, False),
        ("user_id", "unique", 2, False),
    ]
    with pytest.raises(ValueError, match="events_raw.user_id unique: 2"):
        require_passing(got)


def test_suite_passes_on_nothing(dirty, rows):
    got = run_checks({"events_raw": dirty.where("false")}, [c for c in CHECKS if c.table == "events_raw"])
    assert rows(got, "passed") == [(True,)] * 4
    require_passing(got)


def test_suite_makes_one_pass_per_table(dirty):
    plan = run_checks(
        {"events_raw": dirty}, [c for c in CHECKS if c.table == "events_raw"]
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Expand" not in plan


def test_unknown_check(dirty):
    with pytest.raises(ValueError, match="unknown check"):
        run_checks({"t": dirty}, [Check("t", "user_id", "odd")])


def test_sample_keeps_whole_users(spark, rows):
    from pyspark.sql import functions as F

    events = spark.range(40_000).select((F.col("id") % 10_000).alias("user_id"), F.lit("view").alias("event_type"))
    sample = sample_users(events)
    per_user = sample.groupBy("user_id").count()
    assert per_user.where("count <> 4").count() == 0
    assert 400 < per_user.count() < 600
    assert rows(sample_users(events.repartition(7)).distinct()) == rows(sample.distinct())
    assert rows(sample_users(events, seed=1).distinct()) != rows(sample.distinct())
    assert sample_users(events, fraction=1.0).count() == 40_000
    assert "Exchange" not in sample._jdf.queryExecution().executedPlan().toString()


def test_sample_fidelity(spark, rows):
    full = spark.createDataFrame([("view",)] * 6 + [("cart",)] * 2 + [(None,)] * 2, "event_type string")
    sample = spark.createDataFrame([("view",)] * 1 + [(None,)] * 1, "event_type string")
    got = {r.event_type: tuple(r)[1:] for r in sample_fidelity(sample, full).collect()}
    assert got == {"view": (6, 1, 0.6, 0.5, pytest.approx(0.1)), "cart": (2, 0, 0.2, 0.0, 0.2),
                   None: (2, 1, 0.2, 0.5, 0.3)}


def test_a_fraction_that_keeps_no_bucket_is_an_error(spark):
    events = spark.range(10).withColumnRenamed("id", "user_id")
    with pytest.raises(ValueError, match="fraction"):
        sample_users(events, fraction=0.00004)
    assert sample_users(events, fraction=0).count() == 0


def _scans(df, kind):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count(kind)


def test_checks_and_fidelity_read_each_table_once(spark, tmp_path):
    import __spark_entry__ as driver

    queries = driver.queries()
    assert _scans(queries["check_suite"](spark, "/root/testdata/sf0.001"), "FileScan") == 6
    assert _scans(queries["sample_fidelity"](spark, "/root/testdata/sf0.001"), "FileScan") == 2


def test_unique_carries_the_other_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "x"), (None, None), (2, "a")], "k int, v string")
    from footfall.operators import Check, run_checks

    checks = [Check("t", "k", "unique"), Check("t", "k", "not_null"), Check("t", "v", "not_null"),
              Check("t", "v", "accepted_values", ("a",)), Check("t", "v", "unique")]
    got = {(r.column_name, r.check_name): r.failures for r in run_checks({"t": df}, checks).collect()}
    assert got == {("k", "unique"): 1, ("k", "not_null"): 2, ("v", "not_null"): 1,
                   ("v", "accepted_values"): 2, ("v", "unique"): 1}
    empty = run_checks({"t": df.where("false")}, checks)
    assert [r.failures for r in empty.collect()] == [0] * 5
    with pytest.raises(ValueError, match="no checks"):
        run_checks({"t": df}, [])
