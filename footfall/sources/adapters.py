"""Views of the star-schema test tables as raw click events.

``events`` is a click stream with one cohort week. ``orders`` spreads its customers over many
cohort weeks and has several orders at the same instant. Both are narrow projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.schema import RAW_EVENTS, conform


# Declared, so that opening a table costs no job.
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


def events_as_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    clicks = events.selectExpr(
        "*", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k"
    ).selectExpr(
        "ts AS event_time",
        "CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type",
        "event_id % 500 AS product_id",
        "k AS category_id",
        "IF(k % 20 = 0, '', concat(' cat.', k % 20)) AS category_code",
        "IF(k % 7 = 0, ' ', concat('brand_', k % 7)) AS brand",
        "value AS price",
        "user_id",
        "concat_ws('-', user_id, date(ts)) AS user_session",
    )
    return conform(clicks, RAW_EVENTS)


def orders_as_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")
    clicks = orders.selectExpr(
        "o_orderdate AS event_time",
        "CASE o_orderstatus WHEN 'O' THEN 'view' WHEN 'P' THEN 'cart' WHEN 'F' THEN 'purchase' END"
        " AS event_type",
        "o_orderkey AS product_id",
        "o_orderkey % 5 AS category_id",
        "IF(o_orderpriority = '4-NOT SPECIFIED', ' ', o_orderpriority) AS category_code",
        "NULL AS brand",
        "o_totalprice AS price",
        "o_custkey AS user_id",
        "concat_ws('-', o_custkey, date(o_orderdate)) AS user_session",
    )
    return conform(clicks, RAW_EVENTS)
