"""CSV loading, layers, snapshots, layouts, the daily rebuild."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from footfall import sources
from footfall.operators import CHECKS, assign_cohorts, retention, sessionize, stage_events
from footfall.plans import daily
from footfall.schema import RAW_EVENTS
from footfall.session import scratch_path
from footfall.sources.layers import RAW_TABLE, STAGING_VIEW, TABLES

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


@pytest.fixture
def csv(tmp_path):
    def write(*lines, name="events.csv"):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def test_csv_values(spark, csv):
    path = csv(
        HEADER,
        '2019-11-01 00:00:00 UTC,view,1,2053013555631882655,a.b,"say ""x"", y",12.345,9007199254740993,s1',
        "2019-11-01 00:00:01.5 UTC,cart,NA,,null,None,nan,,N/A",
        "2019-11-01 00:00:02,cart,3,4, ,NULL ,1,5, s ",
    )
    df = sources.read_events_csv(spark, path)
    assert dict(df.dtypes) == RAW_EVENTS
    assert [tuple(r) for r in df.orderBy("event_time").collect()] == [
        (dt.datetime(2019, 11, 1), "view", 1, 2053013555631882655, "a.b", 'say "x", y', D("12.35"),
         9007199254740993, "s1"),
        (dt.datetime(2019, 11, 1, 0, 0, 1, 500000), "cart", None, None, None, None, None, None, None),
        (dt.datetime(2019, 11, 1, 0, 0, 2), "cart", 3, 4, " ", "NULL ", D("1.00"), 5, " s "),
    ]


def test_csv_reordered_extra_and_missing_columns(spark, csv, rows, caplog):
    path = csv("user_id,extra,event_type,event_time", "7,zzz,view,2019-11-01 00:00:00 UTC")
    with caplog.at_level("INFO"):
        df = sources.read_events_csv(spark, path)
    assert rows(df, "user_id", "event_type", "brand", "price") == [(7, "view", None, None)]
    assert "extra" in caplog.text and "brand" in caplog.text


def test_csv_other_names(spark, csv, rows):
    path = csv("who,what.kind", "7,view")
    df = sources.read_events_csv(spark, path, {"who": "user_id", "what.kind": "event_type"})
    assert rows(df, "user_id", "event_type", "price") == [(7, "view", None)]


def test_csv_errors(spark, csv, tmp_path):
    with pytest.raises(ValueError, match="no known column"):
        sources.read_events_csv(spark, csv("a,b", "1,2"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sources.read_events_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sources.read_events_csv(spark, csv("user_id", "x7", name="bad.csv")).collect()


def test_csv_folder_with_unlike_headers_is_an_error(spark, csv, tmp_path):
    csv("user_id,event_type", "1,view", name="a.csv")
    csv("event_type,user_id", "view,2", name="b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_events_csv(spark, str(tmp_path)).collect()


def test_csv_line_breaks_in_quotes(spark, csv, rows):
    path = csv("user_id,brand,event_type", '1,"a', 'b",view')
    df = sources.read_events_csv(spark, path, multi_line=True)
    assert rows(df, "user_id", "brand", "event_type") == [(1, "a\nb", "view")]


def test_daily_rebuild_twice(spark, csv, rows, tmp_path):
    path = csv(
        HEADER,
        "2019-11-01 00:00:00 UTC,view,1,1,a.b,x,1.00,1,s1",
        "2019-11-01 00:10:00 UTC,purchase,1,1,a.b,x,4.00,1,s1",
        "2019-11-12 00:00:00 UTC,view,1,1,,x,1.00,1,s2",
        "2019-11-29 00:00:00 UTC,cart,1,1,,x,1.00,2,s3",
    )
    for _ in range(2):
        assert daily.run_daily(spark, path) == 4
    assert spark.table(RAW_TABLE).count() == 4
    assert spark.table(RAW_TABLE).where("ingested_at IS NULL").count() == 0
    assert rows(sources.query(spark, "SELECT user_id, session_seq FROM intermediate.sessions")) == [
        (1, 1), (1, 2), (2, 1)]
    assert rows(sources.query(spark, "SELECT stage, users FROM marts.funnel")) == [
        ("cart", 1), ("purchase", 1), ("view", 1)]
    assert rows(spark.table(STAGING_VIEW)) == rows(stage_events(spark.table(RAW_TABLE)))
    assert rows(daily.check_layers(spark), "failures", "passed") == [(0, True)] * len(CHECKS)
    assert rows(sources.load_report(spark, "kpi_summary", str(tmp_path), live=True)) == [(2, 3, 1, D("4.00"), 4)]
    assert rows(sources.load_report(spark, "cohort", str(tmp_path), live=True), "user_id") == [(1,), (2,)]

    daily.publish(spark, str(tmp_path / "published"))
    got = spark.read.parquet(str(tmp_path / "published/sessions"))
    assert rows(got.drop("session_date")) == rows(spark.table(TABLES["sessions"]))
    assert {f.name for f in got.schema} >= {"session_date"}


def test_daily_rebuild_fails_on_a_failed_check(spark, csv):
    path = csv(HEADER, "2019-11-01 00:00:00 UTC,remove_from_cart,1,1,a,x,1.00,1,s1",
               "2019-11-01 00:00:00 UTC,view,1,1,a,x,1.00,,s1")
    with pytest.raises(ValueError, match="events_raw.event_type accepted_values: 1; events_raw.user_id not_null: 1"):
        daily.run_daily(spark, path)


@pytest.fixture(scope="module")
def clicks(spark):
    return stage_events(sources.events_as_clicks(spark, "/root/testdata/sf0.001"))


def test_snapshots(spark, clicks, rows, tmp_path):
    from footfall.operators import funnel

    out = str(tmp_path / "snapshots")
    tables = {STAGING_VIEW: clicks.where("false"), TABLES["funnel"]: funnel(clicks),
              TABLES["retention"]: retention(clicks), TABLES["cohort"]: assign_cohorts(clicks)}
    for _ in range(2):
        sources.export_snapshots(tables, out, sources.REPORTS)
    manifest = {r.snapshot: r for r in sources.snapshot_manifest(spark, out, sources.REPORTS).collect()}
    assert {k: r.rows for k, r in manifest.items()} == {
        "kpi_summary": 1, "funnel": 3, "retention": 5, "daily_activity": 0, "top_categories": 0,
        "cohort": 15, "total": 24}
    files = {k: list((tmp_path / "snapshots" / k).glob("*.parquet")) for k in sources.REPORTS}
    assert all(len(files[k]) == 1 for k in files if sources.REPORTS[k].small)
    sizes = {k: sum(f.stat().st_size for f in fs) for k, fs in files.items()}
    assert {k: manifest[k].bytes for k in sizes} == sizes
    assert manifest["total"].bytes == sum(sizes.values())


def test_load_report_reads_what_it_is_told_to(spark, clicks, rows, tmp_path):
    from footfall.operators import funnel

    with pytest.raises(FileNotFoundError, match="funnel"):
        sources.load_report(spark, "funnel", str(tmp_path), live=False)
    sources.export_snapshots({TABLES["funnel"]: funnel(clicks)}, str(tmp_path), ["funnel"])
    sources.create_layers(spark)
    sources.replace_table(funnel(clicks.where("false")), TABLES["funnel"])
    assert rows(sources.load_report(spark, "funnel", str(tmp_path), live=False)) == rows(funnel(clicks))
    assert rows(sources.load_report(spark, "funnel", str(tmp_path), live=True)) != rows(funnel(clicks))


def test_snapshot_query_ignores_the_catalog(spark, raw, rows):
    import __spark_entry__ as driver

    query = driver.queries()["snapshot_load"]
    before = rows(query(spark, "/root/testdata/sf0.001"))
    sources.create_layers(spark)
    sources.replace_table(raw(), RAW_TABLE)
    sources.replace_staging_view(spark)
    assert rows(query(spark, "/root/testdata/sf0.001")) == before


def test_failed_load_keeps_the_earlier_rows(spark, csv, rows):
    good = csv("user_id,event_type,event_time", "1,view,2019-11-01 00:00:00 UTC", name="good.csv")
    bad = csv("user_id,event_type,event_time", "x,view,2019-11-01 00:00:00 UTC", name="bad.csv")
    sources.create_layers(spark, "safe_")
    for _ in range(2):
        assert sources.reload_raw_events(spark, good, "safe_") == 1
    sources.replace_staging_view(spark, "safe_")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sources.reload_raw_events(spark, bad, "safe_")
    assert rows(spark.table("safe_" + RAW_TABLE), "user_id") == [(1,)]
    assert rows(spark.table("safe_" + STAGING_VIEW), "user_id") == [(1,)]
    # A table can be rebuilt from itself, also with other columns.
    again = sources.replace_table(spark.table("safe_" + RAW_TABLE).selectExpr("user_id + 1 AS n"), "safe_" + RAW_TABLE)
    assert rows(again) == [(2,)]


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_lines_unlike_the_header(spark, csv, rows, multi_line):
    def load(*lines):
        path = csv("user_id,event_type,brand", *lines, name="odd.csv")
        return sources.read_events_csv(spark, path, multi_line=multi_line)

    short = load("1,view", '2,cart,"a,b"', "3,view,x", '4,"v, w"')
    assert rows(short, "user_id", "event_type", "brand") == [
        (1, "view", None), (2, "cart", "a,b"), (3, "view", "x"), (4, "v, w", None)]
    assert short.count() == 4
    for line in ("1,view,x,y", "1,view,x,", "1,view,x,,,", '1,view,"x,y","z"'):
        with pytest.raises(Exception, match="more fields than the header"):
            load("2,cart,x", line).collect()
        with pytest.raises(Exception, match="more fields than the header"):
            load("2,cart,x", line).count()


def test_marts_from_user_weeks(spark, rows):
    from footfall.operators import funnel, funnel_from_weeks, retention_from_weeks, user_weeks

    for adapter in (sources.events_as_clicks, sources.orders_as_clicks):
        events = stage_events(adapter(spark, "/root/testdata/sf0.001"))
        weeks = user_weeks(events)
        assert rows(assign_cohorts(weeks, "first_event_at")) == rows(assign_cohorts(events))
        assert rows(funnel_from_weeks(weeks)) == rows(funnel(events))
        assert rows(retention_from_weeks(weeks)) == rows(retention(events))



def test_layout_splits_a_heavy_day_into_disjoint_user_ranges(spark, rows, tmp_path):
    """A third of the sessions fall on one day; its files do not overlap in users."""
    sessions = spark.range(3000).select(
        F.col("id").alias("user_id"), F.col("id").cast("string").alias("session_key"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01 05:00:00"))
        .otherwise(F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"), F.lit(" 01:00:00")))
        .cast("timestamp_ntz").alias("session_start"),
    )
    path = str(tmp_path / "layout")
    sources.write_layout(sessions, "sessions", path, files=8)
    got = spark.read.parquet(path)
    assert rows(got.drop("session_date")) == rows(sessions.select(*got.drop("session_date").columns))
    heavy = got.where("session_date = DATE '2024-01-01'").select("user_id", F.col("_metadata.file_path").alias("f"))
    spans = sorted(tuple(r)[1:] for r in heavy.groupBy("f").agg(F.min("user_id"), F.max("user_id")).collect())
    assert len(spans) > 1
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def _day_table(spark, days, each):
    return spark.range(days * each).select(
        F.col("id").alias("user_id"), F.col("id").cast("string").alias("session_key"),
        F.expr(f"timestamp_ntz'2024-01-01 08:00:00' + make_interval(0, 0, 0, CAST(id div {each} AS INT))").alias("session_start"),
    )


@pytest.mark.parametrize("least, folders", [(5, 60), (6, 2), (150, 2), (151, 1), (301, 1)])
def test_small_days_share_a_folder(spark, rows, tmp_path, least, folders):
    """60 days of five rows in two months of one year."""
    sessions = _day_table(spark, 60, 5)
    path = tmp_path / "layout"
    sources.write_layout(sessions, "sessions", str(path), files=4, least=least)
    got = sources.read_layout(spark, str(path))
    assert got.columns == [*sessions.columns, "session_date"]
    assert rows(got.drop("session_date")) == rows(sessions)
    assert got.where("session_date <> CAST(session_start AS DATE)").isEmpty()
    assert len(list(path.glob("folder=*"))) == (folders if folders > 1 else 0)
    assert len(list(path.rglob("*.parquet"))) <= folders + 4


def test_a_date_still_skips_files_of_a_shared_folder(spark, tmp_path):
    path = str(tmp_path / "layout")
    sources.write_layout(_day_table(spark, 60, 50), "sessions", path, files=6, least=1000)
    spans = sources.read_layout(spark, path).groupBy(F.input_file_name()).agg(F.min("session_date").alias("a"), F.max("session_date").alias("z"))
    spans = sorted((r.a, r.z) for r in spans.collect())
    assert len(spans) in (6, 7) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_another_schema_is_swapped_in(spark, rows):
    """The table is never away: a reader between the renames sees the earlier or the new one."""
    sources.create_layers(spark, "swap_")
    table = "swap_marts.facts"
    first = sources.replace_table(spark.range(3), table)
    assert rows(first) == [(0,), (1,), (2,)]
    second = sources.replace_table(spark.range(2).selectExpr("id", "'x' AS name"), table)
    assert rows(second) == [(0, "x"), (1, "x")] == rows(spark.table(table))
    assert [t.name for t in spark.catalog.listTables("swap_marts")] == ["facts"]
    sources.drop_layers(spark, "swap_")
    assert not spark.catalog.databaseExists("swap_marts")


def test_the_layers_themselves_are_not_dropped(spark):
    with pytest.raises(ValueError):
        sources.drop_layers(spark, "")


def test_layout_refuses_a_missing_required_column(spark, tmp_path, rows):
    bad = spark.createDataFrame([(None, "2024-01-01")], "user_id bigint, m string").selectExpr(
        "user_id", "CAST(NULL AS TIMESTAMP_NTZ) AS first_event_at", "CAST(m AS DATE) AS cohort_week",
        "CAST(m AS DATE) AS cohort_month")
    with pytest.raises(Exception, match="required column user_id is NULL"):
        sources.write_layout(bad, "cohort", str(tmp_path / "bad"))


def test_layout_round_trip(spark, clicks, rows, tmp_path):
    for name, df in {"cohort": assign_cohorts(clicks), "retention": retention(clicks),
                     "sessions": sessionize(clicks)}.items():
        for _ in range(2):
            sources.write_layout(df, name, str(tmp_path / name))
        assert rows(spark.read.parquet(str(tmp_path / name)), *df.columns) == rows(df)


def test_scratch_path_is_new_each_time(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_scratch_path_prefers_the_cluster_folder():
    class Cluster:
        """Just the two settings the function reads."""

        def __init__(self, shared):
            self.conf = {"spark.checkpoint.dir": shared} if shared else {}
            self.sparkContext = type("Context", (), {"master": "yarn"})

    assert scratch_path(Cluster("hdfs://shared/scratch/"), "csv").startswith("hdfs://shared/scratch/footfall-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Cluster(None), "csv")


def test_commands(spark, csv, tmp_path, capsys):
    from footfall.__main__ import main

    path = csv(HEADER, "2019-11-01 00:00:00 UTC,view,1,1,a.b,x,1.00,1,s1", name="command.csv")
    assert main(["load", path]) == 0
    assert main(["rebuild", path]) == 0
    assert main(["export", str(tmp_path / "out")]) == 0
    assert "kpi_summary" in capsys.readouterr().out
    assert main(["load", str(tmp_path / "absent.csv")]) == 1
