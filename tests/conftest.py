import datetime as dt
import glob
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stockpulse import schemas  # noqa: E402
from stockpulse.session import build_session  # noqa: E402
from stockpulse.sources import retail  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return retail.load(spark, SF)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def day(i: int, start: str = "2023-01-02") -> dt.date:
    """Day i after a Monday."""
    return dt.date.fromisoformat(start) + dt.timedelta(days=i)


def sales_rows(spark, quantities, sku="A", region="R", days=None, promo=(), start="2023-01-02"):
    """Fact rows of one series; ``quantities`` in date order."""
    days = list(range(len(quantities))) if days is None else list(days)
    rows = []
    for i, q in zip(days, quantities):
        d = day(i, start)
        holiday = d.month * 100 + d.day in (101, 126, 815, 1002, 1225)
        rows.append((sku, region, d, int(q), None, 0, holiday, i in promo, None, None))
    schema = "sku_id string, region string, date date, sales_qty long, revenue_inr decimal(14,2), returns_qty long, " \
             "is_holiday boolean, is_promotion boolean, promo_id string, weather_score decimal(6,3)"
    return spark.createDataFrame(rows, schema)


def empty(spark, table: str):
    return spark.createDataFrame([], schemas.TABLES[table])


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
