"""Lags, rolling values, year-over-year, densifying, enrichment."""

from decimal import Decimal

import pytest
from conftest import day, empty, sales_rows
from pyspark.sql import functions as F

from stockpulse.operators import features


def build(spark, sales, run=None, weather=None, competitor=None, **kw):
    run = run or sales.agg(F.max("date")).first()[0]
    return features.build_features(sales, weather or empty(spark, "weather_scores"), competitor or empty(spark, "competitor_events"), run, **kw)


def test_dense_series(spark):
    sales = sales_rows(spark, [100 + i for i in range(400)])
    rows = {r.date: r for r in build(spark, sales).collect()}
    r = rows[day(399)]
    assert (r.lag_7, r.lag_14, r.lag_21, r.lag_28) == (492, 485, 478, 471)
    assert r.rolling_mean_7 == 495.0 and r.rolling_mean_28 == 484.5
    assert r.rolling_std_7 == pytest.approx(2.160246899)
    assert r.yoy_ratio == pytest.approx(499 / (134 + 1))
    assert r.day_of_week == day(399).weekday() and r.month == day(399).month
    assert len(rows) == 393


def test_calendar_equals_rows_without_gaps(spark):
    sales = sales_rows(spark, [(i * 7) % 31 for i in range(120)])
    a = sorted(map(str, build(spark, sales).collect()))
    assert a == sorted(map(str, build(spark, sales, mode="calendar").collect()))


def test_gap_shifts_row_lags_only(spark):
    kept = [i for i in range(100) if not 50 <= i <= 59]
    sales = sales_rows(spark, [100 + i for i in kept], days=kept)
    rows = {r.date: r for r in build(spark, sales).collect()}
    cal = {r.date: r for r in build(spark, sales, mode="calendar").collect()}
    assert rows[day(62)].lag_7 == 100 + 45
    assert cal[day(62)].lag_7 == 0
    assert cal[day(67)].lag_7 == 160
    assert day(55) in cal and cal[day(55)].sales_qty == 0 and day(55) not in rows


@pytest.mark.parametrize("n", [0, 6, 7, 8, 13])
def test_short_series(spark, n):
    sales = sales_rows(spark, [1] * n)
    assert build(spark, sales, run=day(n)).count() == max(0, n - 7)


def test_series_do_not_leak(spark):
    parts = [sales_rows(spark, [base + i for i in range(20)], s, r) for base, s, r in
             [(0, "A", "R"), (1000, "A", "Q"), (2000, "B", "R"), (3000, "B", "Q")]]
    sales = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    for r in build(spark, sales).collect():
        assert r.sales_qty - r.lag_7 == 7


def test_competitor_duplicates_do_not_multiply(spark):
    sales = sales_rows(spark, [5] * 10)
    comp = spark.createDataFrame([("A", day(9), "x", Decimal(10), None), ("A", day(9), "y", Decimal(20), None)],
                                 "sku_id string, date date, competitor_name string, price_delta_pct decimal(7,3), source_url string")
    rows = build(spark, sales, competitor=comp).collect()
    assert len(rows) == 3
    assert [r.competitor_price_delta for r in sorted(rows, key=lambda r: r.date)] == [0.0, 0.0, 15.0]


def test_min_periods(spark):
    sales = sales_rows(spark, range(40))
    assert build(spark, sales, min_periods="full").filter("rolling_mean_28 IS NULL").count() == 28 - 7
    det = {r.date: r for r in features.detector_features(sales_rows(spark, range(12))).collect()}
    assert min(det) == day(7) and det[day(7)].lag_28 == det[day(7)].rolling_mean_7 and det[day(7)].yoy_ratio == 1.0
    assert features.forecaster_features(sales).count() == 40 - 28


def test_drop_and_band(spark):
    inv = spark.createDataFrame([("A", "R", day(0), 100), ("A", "R", day(1), 60), ("A", "R", day(2), 90), ("A", "R", day(3), 0), ("A", "R", day(4), 5)],
                                "sku_id string, region string, date date, quantity_on_hand int")
    got = [round(r.inventory_drop_pct, 4) for r in features.inventory_drop(inv).orderBy("date").collect()]
    assert got == [0.0, 40.0, 0.0, 100.0, 0.0]
    flags = features.two_sigma_flags(sales_rows(spark, [10, 11] * 10 + [50])).filter("outside").collect()
    assert [r.sales_qty for r in flags] == [50]


def test_absent_optional_columns(spark):
    bare = sales_rows(spark, range(10)).select("sku_id", "region", "date", "sales_qty")
    r = features.detector_features(bare).first()
    assert (r.is_holiday, r.is_promotion, r.weather_score, r.competitor_price_delta) == (False, False, 0.0, 0.0)
