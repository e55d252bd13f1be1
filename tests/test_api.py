"""Argument checks and response shapes of the public functions."""

import pytest

from stockpulse.plans import api


@pytest.mark.parametrize("call", [
    lambda t: api.forecast(t, horizon_days=6), lambda t: api.forecast(t, horizon_days=366), lambda t: api.forecast(t, model="arima"),
    lambda t: api.restock_plan(t, priority="urgent"), lambda t: api.restock_plan(t, limit=501),
    lambda t: api.detect_anomalies(t, days_back=0), lambda t: api.detect_anomalies(t, days_back=181), lambda t: api.detect_anomalies(t, min_score=1.1),
    lambda t: api.sku_clusters(t, n_clusters=1), lambda t: api.sku_clusters(t, n_clusters=11),
    lambda t: api.regional_kpis(t, "2001-02-01", "2001-01-01"), lambda t: api.promo_impact(t, [], "2001-01-01", "2001-01-02"),
    lambda t: api.promo_impact(t, ["A"], "2001-01-03", "2001-01-02"), lambda t: api.promo_impact(t, ["A"], "2001-01-01", "2001-01-02", "gift"),
    lambda t: api.portfolio_kpis(t, 0),
])
def test_guards(tables, call):
    with pytest.raises(ValueError):
        call(tables)


def test_unknown_series(tables):
    with pytest.raises(KeyError):
        api.forecast(tables, "Brand#999", "ASIA")


def test_forecast_response(tables):
    points = api.forecast(tables, "Brand#1", "ASIA", horizon_days=7, model="seasonal", include_ci=False)
    r = api.forecast_response(tables, points, 7).first()
    assert len(r.forecast) == 7 and [p.date for p in r.forecast] == sorted(p.date for p in r.forecast)
    assert r.forecast[0].lower_bound is None and r.seasonal_components.trend_slope_per_day is not None


def test_portfolio_row(tables):
    r = api.portfolio_kpis(tables).first()
    assert 0 <= r.fulfillment_rate <= 100 and 0 <= r.demand_coverage_pct <= 100 and r.model_drift_alerts >= 0


def test_regional_default_period(tables):
    rows = api.regional_kpis(tables).collect()
    assert [r.total_sales for r in rows] == sorted((r.total_sales for r in rows), reverse=True)


def test_impact_parts(tables):
    parts = api.promo_impact(tables, ["Brand#1", "Brand#2"], "2001-02-01", "2001-03-31", discount_pct=10.0)
    assert set(parts) == {"lift", "decay", "cannibalization", "attribution"} and parts["lift"].count() == 1


def dense(spark, long_rows=200, short_rows=40):
    """Two series of different length ending on the same day."""
    from conftest import day, sales_rows

    a = sales_rows(spark, [20 + i % 7 for i in range(long_rows)])
    b = sales_rows(spark, [10 + i % 3 for i in range(short_rows)], "B", days=range(long_rows - short_rows, long_rows))
    return a.unionByName(b), day(long_rows - 1)


def test_train_gate_promote(spark, tables):
    """Errors of the models, the gate on them, and a promotion."""
    from types import SimpleNamespace

    from stockpulse.operators import monitoring
    from stockpulse.plans import jobs

    sales, as_of = dense(spark, 400, 150)
    small = SimpleNamespace(sales=sales, as_of=as_of)
    errors = jobs.train_all(small, "lookback").unionByName(jobs.train_all(small, "seasonal")).unionByName(
        jobs.train_all(small, "boosted", maxIter=5, maxDepth=3))
    rows = errors.collect()
    assert [r.model_name for r in rows] == ["lookback", "seasonal", "boosted"] and all(r.avg_mape < 40 for r in rows)
    assert monitoring.quality_gate(errors, threshold=40).first().passed
    assert monitoring.promote_versions(tables.model_versions).filter("stage = 'Production'").count() == 2
    with pytest.raises(ValueError):
        jobs.train_all(small, "other")


def test_members_and_fallback(spark):
    """The short series takes the boosted value in place of the lookback."""
    sales, as_of = dense(spark)
    rows = api.forecast_members(sales, as_of, 7, maxIter=5, maxDepth=3).collect()
    assert len(rows) == 2 * 7 and all(r.boosted >= 0 for r in rows)
    assert all(r.lookback == r.boosted for r in rows if r.sku_id == "B")
    own = {r.date: r.lookback for r in rows if r.sku_id == "A"}  # A has its own, whatever the boosted model says
    alone = api.forecasting.lookback_forecast(api.forecasting.lookback_params(sales.filter("sku_id = 'A'")), 7)
    assert own == {r.date: r.lookback for r in alone.collect()}


def test_no_training_rows(spark):
    from conftest import day, sales_rows

    with pytest.raises(ValueError):
        api.forecast_members(sales_rows(spark, [1, 2]), day(1), 7)
