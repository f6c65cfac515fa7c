import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from footfall.schema import RAW_EVENTS, STG_EVENTS
from footfall.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests", "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": 8,
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _frame(spark, contract, rows):
    schema = ", ".join(f"{name} string" for name in contract)
    filled = [tuple(None if row.get(c) is None else str(row[c]) for c in contract) for row in rows]
    text = spark.createDataFrame(filled, schema)
    return text.selectExpr(*[f"CAST({c} AS {kind}) AS {c}" for c, kind in contract.items()])


@pytest.fixture(scope="session")
def raw(spark):
    """raw(dict, ...) -> raw events; columns left out are NULL."""
    return lambda *rows: _frame(spark, RAW_EVENTS, rows)


@pytest.fixture(scope="session")
def staged(spark):
    """staged((user, time, type[, price[, category[, session]]]), ...) -> staged events."""
    names = ("user_id", "event_at", "event_type", "price", "category_code", "session_id")

    def build(*rows):
        return _frame(spark, STG_EVENTS, [dict(zip(names, row)) for row in rows])

    return build


@pytest.fixture(scope="session")
def rows():
    """rows(df, 'a', 'b') -> sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda row: [str(v) for v in row])

    return collect
