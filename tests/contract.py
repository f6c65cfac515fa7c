"""Compare a query with its oracle: columns by name, rows in any order, values exactly."""

from __future__ import annotations

import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("number", float(value))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (int, float)):
        return ("nan",) if isinstance(value, float) and math.isnan(value) else ("number", float(value))
    return (type(value).__name__, str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def oracle_result(con, sql):
    cursor = con.execute(sql)
    return canonical([c[0] for c in cursor.description], cursor.fetchall())
