"""Forecast members on known signals, ensemble bounds, walk-forward evaluation."""

import math

import pytest
from conftest import SF, day, sales_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockpulse.operators import boosting, forecasting, kpis
from stockpulse.plans import queries

WEEK = [1.0, 1.2, 0.8, 1.0, 1.5, 0.5, 1.0]


def test_trend_and_weekday_recovered(spark):
    sales = sales_rows(spark, [round((200 + 2 * i) * WEEK[i % 7]) for i in range(728)])
    p = forecasting.seasonal_params(sales).first()
    assert p.slope == pytest.approx(2.0, abs=0.05)
    assert list(p.weekly) == pytest.approx(WEEK, abs=0.02)
    fc = forecasting.seasonal_forecast(forecasting.seasonal_params(sales), 14).orderBy("date").collect()
    assert [r.date for r in fc] == [day(728 + i) for i in range(14)]
    for i, r in enumerate(fc):
        assert r.seasonal == pytest.approx((200 + 2 * (728 + i)) * WEEK[(728 + i) % 7], rel=0.1)
        assert r.lower_bound <= r.seasonal <= r.upper_bound


def test_promotion_effect_is_planned_only(spark):
    promo = {i for i in range(200) if i % 5 == 0}
    sales = sales_rows(spark, [200 if i in promo else 100 for i in range(200)], promo=promo)
    params = forecasting.seasonal_params(sales)
    assert params.first().promo_effect == pytest.approx(2.0, abs=0.1)
    plan = spark.createDataFrame([("A", "R", day(201))], "sku_id string, region string, date date")
    rows = {r.date: r.seasonal for r in forecasting.seasonal_forecast(params, 2, planned_promos=plan).collect()}
    base = {r.date: r.seasonal for r in forecasting.seasonal_forecast(params, 2).collect()}
    assert rows[day(200)] == base[day(200)] and rows[day(201)] == pytest.approx(base[day(201)] * params.first().promo_effect)


def test_degenerate_series(spark):
    sales = sales_rows(spark, [7], "one").unionByName(sales_rows(spark, [0] * 70, "zero"))
    got = {r.sku_id: r.seasonal for r in forecasting.seasonal_forecast(forecasting.seasonal_params(sales), 1).collect()}
    assert got == {"one": 7.0, "zero": 0.0}
    look = {r.sku_id: r.lookback for r in forecasting.lookback_forecast(forecasting.lookback_params(sales), 1).collect()}
    assert look == {"zero": 0.0}


def test_lookback_weights(spark):
    sales = sales_rows(spark, [10] * 60 + [30] * 60)
    level = forecasting.lookback_params(sales).first().level
    assert level == pytest.approx(30, rel=0.02)


def test_naive_reaches_a_year_ahead(spark):
    sales = sales_rows(spark, range(800))
    got = {r.date: r.naive for r in forecasting.seasonal_naive(sales, 365).collect()}
    assert len(got) == 365 and got[day(800)] == 800 - 364 and got[day(1164)] == 1164 - 728


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(*[st.floats(0, 1000)] * 3), min_size=1, max_size=20))
def test_ensemble_lies_between_members(spark, rows):
    df = spark.createDataFrame([("A", "R", day(i), *r, 0.0, 1.0) for i, r in enumerate(rows)],
                               "sku_id string, region string, date date, seasonal double, boosted double, lookback double, lower_bound double, upper_bound double")
    for out, r in zip(forecasting.ensemble(df).orderBy("date").collect(), rows):
        assert min(r) - 0.051 <= out.predicted_demand <= max(r) + 0.051


def test_missing_member_and_choice(spark):
    df = spark.createDataFrame([("A", "R", day(0), 10.0, None, 40.0, 1.0, 2.0)],
                               "sku_id string, region string, date date, seasonal double, boosted double, lookback double, lower_bound double, upper_bound double")
    assert forecasting.ensemble(df).first().predicted_demand == 20.0
    r = forecasting.ensemble(df, model="lookback", include_ci=False).first()
    assert (r.predicted_demand, r.lower_bound, r.model_used) == (40.0, None, "lookback")


def test_tuning_finds_the_exact_member(spark):
    rows = [("c", float(i), float(i), 2.0 * i, 0.0) for i in range(1, 20)] + [("d", float(i), 0.0, 0.5 * i, 1.5 * i) for i in range(1, 20)]
    df = spark.createDataFrame(rows, "category string, actual double, seasonal double, naive double, lookback double")
    got = {r.category: r for r in forecasting.tune_weights(df).collect()}
    assert got["c"].wape == 0.0 and (got["d"].w_naive, got["d"].w_lookback) == (0.5, 0.5)


def test_backtest_trains_on_the_past_only(spark):
    quiet = [10] * 300
    shocked = sales_rows(spark, quiet + [1000] * 28)
    r = forecasting.backtest(shocked, day(327), folds=1, horizon=28, model="seasonal").first()
    assert r.rows == 28 and r.mape == pytest.approx(99.0, abs=0.1)
    assert forecasting.backtest(shocked, day(327), folds=2, horizon=28, model="lookback").filter("fold = 2").first().mape == pytest.approx(0.0, abs=1e-6)
    with pytest.raises(ValueError):
        forecasting.backtest(shocked, day(327), model="other")


def test_strength_equals_formula(spark):
    import numpy as np

    q = [round(50 * WEEK[i % 7] + i) for i in range(90)]
    r = forecasting.seasonal_strength(sales_rows(spark, q)).first()
    weekday = [np.mean([v for i, v in enumerate(q) if i % 7 == k]) for k in range(7)]
    assert r.weekly_amplitude == pytest.approx(np.std(weekday, ddof=1))
    assert r.trend_slope_per_day == pytest.approx(np.polyfit(range(90), q, 1)[0])
    assert math.isfinite(r.monthly_amplitude)


def test_boosted_beats_naive_on_a_signal(spark):
    """A level shift since last year: the yearly naive misses it, the features carry it."""
    parts = [sales_rows(spark, [round(base * WEEK[i % 7] * (1 if i < 450 else 2)) for i in range(760)], f"S{base}") for base in (50, 80, 120, 200)]
    sales = parts[0]
    for p in parts[1:]:
        sales = sales.unionByName(p)
    as_of = day(731)
    train, test = sales.filter(F.col("date") <= F.lit(as_of)), sales.filter(F.col("date") > F.lit(as_of))
    model = boosting.fit_gbt(train, as_of, 28, maxIter=25, maxDepth=5)
    on = ["sku_id", "region", "date"]
    actual = test.select(*on, F.col("sales_qty").alias("actual"))
    boosted = kpis.forecast_errors(boosting.gbt_forecast(model, train, 28).withColumnRenamed("boosted", "predicted").join(actual, on)).first()
    naive = kpis.forecast_errors(forecasting.seasonal_naive(train, 28).withColumnRenamed("naive", "predicted").join(actual, on)).first()
    assert boosted.rows == naive.rows == 112 and boosted.wape < naive.wape


def test_training_rows_do_not_look_ahead(spark):
    sales = sales_rows(spark, range(1, 201))
    rows = boosting.training_rows(sales, day(199), 14, train_days=100).collect()
    assert rows
    for r in rows:
        assert r.label == r.lag_0 + r.horizon and (r.date - r.origin).days == r.horizon and r.series_mean < r.lag_0


@pytest.mark.parametrize("name", ["gbt_forecast", "forecast_ensemble"])
def test_registered_queries_fit_with_the_full_settings(spark, monkeypatch, name):
    class Fitted(Exception):
        pass

    def learner(**options):
        assert {k: options[k] for k in boosting.GBT_PARAMS} == boosting.GBT_PARAMS
        raise Fitted

    monkeypatch.setattr(boosting, "GBTRegressor", learner)
    with pytest.raises(Fitted):
        queries.REGISTRY[name](spark, SF)
