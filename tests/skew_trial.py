"""Timings at tens of millions of events with one hot user; not collected by pytest.

    python tests/skew_trial.py [copies] [scratch_dir]

Every click of the sf0.1 ``events`` table becomes ``copies`` bursts of five clicks, seven
seconds apart. Every third copy belongs to user 0, who so holds a third of all events; the
others belong to new users. The slot form of ``sessionize`` is compared with windows over
single events, and the roll-ups with plain distinct counts.
"""

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.operators import assign_cohorts, funnel, retention, sessionize, stage_events
from footfall.plans import activity
from footfall.session import get_session
from footfall.sources import events_as_clicks

BURST = 5


def multiply(raw, copies):
    many = raw.selectExpr("*", f"explode(sequence(1, {copies})) AS copy").selectExpr(
        "*", f"explode(sequence(0, {BURST - 1})) AS nth"
    )
    return many.withColumns({
        "event_time": F.expr("event_time + make_dt_interval(0, 0, 0, 7 * nth + copy)"),
        "user_id": F.expr("IF(copy % 3 = 0, 0, 1 + user_id + copy * 100000)"),
    }).drop("copy", "nth")


def sessions_by_event(events):
    mine = Window.partitionBy("user_id").orderBy("event_at")
    silence = F.col("event_at") - F.lag("event_at").over(mine)
    flagged = events.withColumn("opens", F.when(silence <= F.expr("INTERVAL '30 minutes'"), 0).otherwise(1))
    return flagged.withColumn("session_seq", F.sum("opens").over(mine)).groupBy("user_id", "session_seq").agg(
        F.min("event_at").alias("session_start"), F.max("event_at").alias("session_end"),
        F.count(F.lit(1)).alias("total_events"),
        F.sum(F.expr("IF(event_type = 'purchase', price, 0)")).alias("revenue"),
    )


def kpis_by_distinct(events):
    bought = F.col("event_type") == "purchase"
    return events.agg(
        F.countDistinct("user_id"), F.countDistinct("session_id"),
        F.countDistinct(F.when(bought, F.col("user_id"))), F.sum(F.when(bought, F.col("price"))),
    )


def days_by_distinct(events):
    bought = F.col("event_type") == "purchase"
    return events.groupBy(F.col("event_at").cast("date")).agg(
        F.countDistinct("user_id"), F.countDistinct(F.when(bought, F.col("user_id"))),
        F.sum(F.when(bought, F.col("price"))),
    )


def main():
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 90
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="footfall-trial-")
    spark = get_session("skew", "local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": 64, "spark.driver.memory": "10g", "spark.local.dir": scratch,
    })
    spark.sparkContext.setLogLevel("ERROR")
    raw = multiply(events_as_clicks(spark, "/root/testdata/sf0.1").repartition(8), copies)
    raw.write.parquet(f"{scratch}/raw")
    events = stage_events(spark.read.parquet(f"{scratch}/raw"))
    print("staged events", events.count(), "of user 0", events.where("user_id = 0").count())

    cases = {
        "sessions, slots": lambda: sessionize(events),
        "sessions, windows over events": lambda: sessions_by_event(events),
        "kpis, two branches": lambda: activity.kpi_summary(events),
        "kpis, distinct counts": lambda: kpis_by_distinct(events),
        "days, roll-up": lambda: activity.daily_activity(events),
        "days, distinct counts": lambda: days_by_distinct(events),
        "retention, one scan": lambda: retention(events),
        "retention, join": lambda: retention(events, assign_cohorts(events)),
        "cohort": lambda: assign_cohorts(events),
        "funnel": lambda: funnel(events),
        "top categories": lambda: activity.top_category_buyers(events),
    }
    best = {}
    for _ in range(2):
        for name, build in cases.items():
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            best[name] = min(best.get(name, 1e9), time.perf_counter() - start)
    for name, took in best.items():
        print(f"{took:7.1f} s  {name}")

    columns = ["user_id", "session_seq", "session_start", "session_end", "total_events", "revenue"]
    def digest(df):
        return df.select(*columns[:-1], F.col("revenue").cast("decimal(20,2)")).agg(
            F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))).first()
    print("same sessions:", digest(sessionize(events)) == digest(sessions_by_event(events)))


if __name__ == "__main__":
    main()
