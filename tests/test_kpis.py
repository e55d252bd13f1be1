"""Indicators on hand-made rows, labels and flags."""

from decimal import Decimal

import pytest
from conftest import day, sales_rows
from pyspark.sql import functions as F

from stockpulse import schemas
from stockpulse.functions import labels
from stockpulse.functions import scalar as fx
from stockpulse.operators import kpis, monitoring


def forecasts(spark, rows):
    full = [("A", "R", day(f), day(t), Decimal(str(p)), None, None, m, "v", None, None) for f, t, p, m in rows]
    return spark.createDataFrame(full, schemas.FORECASTS)


def stock(spark, rows):
    full = [("A", w, "R", day(d), q, 0, 0, 10, 7, Decimal("100.00")) for w, d, q in rows]
    return spark.createDataFrame(full, schemas.INVENTORY)


def test_daily_kpis_keep_one_row_per_key(spark):
    sales = sales_rows(spark, [10, 0, 5, 8])
    fc = forecasts(spark, [(-7, 0, 20, "ensemble"), (-1, 0, 12, "ensemble"), (-1, 0, 99, "naive"), (0, 1, 3, "ensemble")])
    inv = stock(spark, [("W1", 0, 0), ("W2", 0, 0), ("W1", 1, 30), ("W2", 1, 0), ("W1", 2, 10), ("W2", 2, 10)])
    rows = kpis.sku_daily_kpis(sales, fc, inv).orderBy("date").collect()
    assert len(rows) == 4
    assert (rows[0].predicted_demand, rows[0].mape, rows[0].stockout_events) == (12.0, 20.0, 1)
    assert rows[1].mape is None and rows[1].overstock_events == 1 and rows[1].predicted_demand == 3.0
    assert (rows[2].overstock_events, rows[2].stock_level, rows[2].reorder_point) == (0, 20, 10)
    assert (rows[3].stock_level, rows[3].reorder_point, rows[3].stockout_events, rows[3].predicted_demand) == (0, 0, 0, None)
    region = kpis.regional_daily_kpis(kpis.sku_daily_kpis(sales, fc, inv)).orderBy("date").collect()
    assert region[0].fulfillment_rate == 0.0 and region[0].avg_mape == 20.0 and region[0].forecast_accuracy_pct == 80.0


def test_forecast_errors_with_zero_actual(spark):
    df = spark.createDataFrame([(10.0, 12.0), (0.0, 3.0), (20.0, 15.0)], "actual double, predicted double")
    r = kpis.forecast_errors(df).first()
    assert r.rows == 3 and r.mape == pytest.approx((20 + 25) / 2) and r.wape == pytest.approx(100 * 10 / 30)
    assert r.rmse == pytest.approx(((4 + 9 + 25) / 3) ** 0.5) and r.bias == pytest.approx(0.0)


def test_monthly_accuracy_floor(spark):
    df = spark.createDataFrame([(day(0), 10, 50.0), (day(40), 10, None)], "date date, actual_sales long, predicted_demand double")
    assert [r.accuracy_pct for r in kpis.monthly_accuracy(df).orderBy("month").collect()] == [0.0, 0.0]


def test_distribution_keeps_empty_labels(spark):
    df = spark.createDataFrame([("Stars",), ("Stars",)], "cluster_label string")
    got = {r.cluster_label: r.sku_count for r in kpis.cluster_distribution(df).collect()}
    assert got == {"Stars": 2, "Cash Cows": 0, "Volume Movers": 0, "Tail SKUs": 0}


CAUSES = [
    # promo, direction, holiday, drop, delta, weather, expected
    (True, "spike", True, 50.0, 20.0, -1.0, "Promotion spike"),
    (True, "drop", True, 50.0, 20.0, -1.0, "Festive demand surge"),
    (False, "drop", False, 30.1, 20.0, -1.0, "Supply disruption"),
    (False, "drop", False, 30.0, -15.1, -1.0, "Competitor price event"),
    (False, "drop", False, 0.0, 15.0, -0.51, "Adverse weather impact"),
    (False, "spike", False, 0.0, 15.0, -0.51, "Unexplained anomaly"),
    (False, "drop", False, None, None, -0.5, "Unexplained anomaly"),
]


def test_causes_in_order(spark):
    df = spark.createDataFrame([c[:6] for c in CAUSES], "is_promotion boolean, direction string, is_holiday boolean, "
                               "inventory_drop_pct double, competitor_price_delta double, weather_score double")
    assert [r[0] for r in df.select(labels.probable_cause()).collect()] == [c[6] for c in CAUSES]


def test_score_and_direction(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (-2.0, -2.0, 0.0), (0.0, -2.0, 0.0)], "raw double, lo double, hi double")
    assert [r[0] for r in df.select(F.round(labels.minmax_score("raw", "lo", "hi"), 6)).collect()] == [1.0, 1.0, 0.0]
    assert spark.range(1).select(labels.direction(F.lit(5), F.lit(5))).first()[0] == "drop"


def test_flags(spark):
    r = spark.range(1).select(labels.lift_band(F.lit(3.0)), labels.below_reorder(F.lit(5), F.lit(5)), labels.low_supply(F.lit(9.9)),
                              labels.strategy(F.lit("Other")), fx.region_city(F.lit("Punjab")), fx.weather_score(F.lit(300.04))).first()
    assert list(r) == ["medium", False, True, "Review manually", "Chandigarh", 0.5]


def test_gate_and_versions(spark):
    m = spark.createDataFrame([("a", 14.9, 10.0), ("b", 15.0, 16.0), ("c", None, None)], "model_name string, avg_mape double, baseline_mape double")
    assert monitoring.quality_gate(m).first().next_step == "promote_models"
    assert monitoring.quality_gate(m, 14.0).first().passed is False
    assert monitoring.quality_gate(m, relative=0.2).first().passed is False
    v = spark.createDataFrame([("a", 1, "Production"), ("a", 2, "Staging"), ("a", 3, "Staging"), ("b", 1, "Production"), ("b", 2, "Archived")],
                              "model_name string, version int, stage string")
    got = {(r.model_name, r.version): r.stage for r in monitoring.promote_versions(v).collect()}
    assert got == {("a", 1): "Archived", ("a", 2): "Staging", ("a", 3): "Production", ("b", 1): "Production", ("b", 2): "Archived"}


def test_psi(spark):
    as_of = day(36)
    same = sales_rows(spark, [i % 5 for i in range(30)] + [0, 1, 2, 3, 4])
    shifted = sales_rows(spark, [i % 5 for i in range(30)] + [90] * 7, "B")
    only_old = sales_rows(spark, [3] * 30, "C")
    got = {r.sku_id: r for r in monitoring.psi(same.unionByName(shifted).unionByName(only_old), as_of).collect()}
    assert set(got) == {"A", "B"}
    assert got["A"].psi == pytest.approx(0.0, abs=1e-9) and not got["A"].drifted
    assert got["B"].psi > 0.2 and got["B"].drifted and got["B"].psi < 100


def test_kaplan_meier(spark):
    spells = spark.createDataFrame([("g", 1, 1), ("g", 2, 1), ("g", 2, 0), ("g", 3, 1), ("h", 2, 1), ("h", 2, 1)], "grp string, duration long, event int")
    got = {(r.grp, r.duration): (r.at_risk, r.events, round(r.survival, 6)) for r in monitoring.kaplan_meier(spells, "grp").collect()}
    assert got == {("g", 1): (4, 1, 0.75), ("g", 2): (3, 1, 0.5), ("g", 3): (1, 1, 0.0), ("h", 2): (2, 2, 0.0)}


def test_spells(spark):
    qty = [5, 5, 0, 0, 5, 5, 5]
    inv = spark.createDataFrame([("A", "R", day(i), q) for i, q in enumerate(qty)], "sku_id string, region string, date date, quantity_on_hand int")
    assert sorted((r.duration, r.event) for r in monitoring.stock_spells(inv).collect()) == [(2, 1), (3, 0)]
