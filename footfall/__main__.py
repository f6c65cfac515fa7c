"""``spark-submit`` entry: ``load``, ``rebuild`` and ``export``.

    spark-submit --py-files footfall.zip footfall/__main__.py load s3a://bucket/events.csv
    spark-submit ... footfall/__main__.py rebuild s3a://bucket/events.csv
    spark-submit ... footfall/__main__.py export s3a://bucket/snapshots

Ends with code 1 when a step fails.
"""

from __future__ import annotations

import argparse
import logging
import sys

from footfall.plans.daily import run_daily
from footfall.session import get_session
from footfall.sources import REPORTS, create_layers, export_snapshots, reload_raw_events, snapshot_manifest

log = logging.getLogger("footfall")


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="footfall")
    steps = parser.add_subparsers(dest="step", required=True)
    steps.add_parser("load", help="replace the raw table with a CSV").add_argument("csv")
    steps.add_parser("rebuild", help="load, build all tables, check them").add_argument("csv")
    steps.add_parser("export", help="write report snapshots and print their manifest").add_argument("out")
    given = parser.parse_args(args)
    logging.basicConfig(level=logging.INFO)
    spark = get_session()
    try:
        if given.step == "load":
            create_layers(spark)
            print(f"{reload_raw_events(spark, given.csv)} rows loaded")
        elif given.step == "rebuild":
            print(f"{run_daily(spark, given.csv)} rows loaded, all checks passed")
        else:
            tables = {report.table: spark.table(report.table) for report in REPORTS.values()}
            export_snapshots(tables, given.out)
            snapshot_manifest(spark, given.out).orderBy("snapshot").show(truncate=False)
    except Exception:
        log.exception("%s failed", given.step)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
