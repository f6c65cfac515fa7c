"""The layers as catalog databases: raw and mart tables, and the staging view."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import staging_sql
from footfall.sources.csv_events import read_events_csv

log = logging.getLogger(__name__)

LAYERS = ("raw", "staging", "intermediate", "marts")

RAW_TABLE = "raw.events_raw"
STAGING_VIEW = "staging.stg_events"
TABLES = {
    "sessions": "intermediate.sessions",
    "cohort": "marts.cohort",
    "funnel": "marts.funnel",
    "retention": "marts.retention",
}


def create_layers(spark: SparkSession, prefix: str = "") -> None:
    """``prefix`` stands before the database names, so that several sets of layers can share a
    catalog."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")


def replace_table(df: DataFrame, table: str) -> DataFrame:
    """Full rebuild: the table holds this frame and nothing else.

    The rows are written aside and the table is pointed to them when they are complete, so a
    run that fails leaves the earlier rows in place, a table can be rebuilt from itself, and a
    run that was cut short is simply repeated. The earlier files go last.
    """
    spark = df.sparkSession
    database, name = table.split(".")
    home = spark.catalog.getDatabase(database).locationUri
    path = f"{home}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    earlier = None
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
    else:
        earlier = _location(spark, table)
        if spark.table(table).schema.simpleString() == df.schema.simpleString():
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        else:
            _swap(df, table, path)
    spark.catalog.refreshTable(table)
    if earlier:
        _remove(spark, earlier)
    return spark.table(table)


def _swap(df: DataFrame, table: str, path: str) -> None:
    """Another schema: the new table is made under a name of its own, and both are renamed. The
    earlier one is dropped last, so at any moment the catalog holds it or the new one."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    spark.catalog.createTable(f"{table}_new_{mark}", path=path, source="parquet", schema=df.schema)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}_old_{mark}")
    spark.sql(f"ALTER TABLE {table}_new_{mark} RENAME TO {table}")
    spark.sql(f"DROP TABLE {table}_old_{mark}")


def drop_layers(spark: SparkSession, prefix: str) -> None:
    """Drop a set of layers that stands beside the others, with its tables and their files."""
    if not prefix:
        raise ValueError("the layers without a prefix are not dropped")
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{layer} CASCADE")


def _location(spark: SparkSession, table: str) -> str:
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return facts.first()["data_type"]


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def replace_staging_view(spark: SparkSession, prefix: str = "") -> DataFrame:
    view = prefix + STAGING_VIEW
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {staging_sql(prefix + RAW_TABLE)}")
    return spark.table(view)


def reload_raw_events(spark: SparkSession, path: str, prefix: str = "", **options: object) -> int:
    """Replace the raw table with the CSV, stamped with the load time. Returns the row count.

    The count comes from the footers of the written files. A counter filled while writing
    would count a task twice when a lost executor makes it run again.
    """
    events = read_events_csv(spark, path, **options)
    stamped = events.withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz"))
    rows = replace_table(stamped, prefix + RAW_TABLE).count()
    log.info("%d rows loaded into %s from %s", rows, prefix + RAW_TABLE, path)
    return rows


def query(spark: SparkSession, sql: str) -> DataFrame:
    """SQL over the layers."""
    return spark.sql(sql)
