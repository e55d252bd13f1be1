"""Inventory formulas and the restock plan on edge rows."""

import datetime as dt
from decimal import Decimal

from conftest import sales_rows
from pyspark.sql import functions as F

from stockpulse import schemas
from stockpulse.functions import scalar as fx
from stockpulse.functions import stock
from stockpulse.operators import restock


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def test_eoq(spark):
    assert one(spark, stock.eoq(F.lit(1000), F.lit(100.0))) == 200
    assert one(spark, stock.eoq(F.lit(0), F.lit(100.0))) == 1
    assert one(spark, stock.eoq(F.lit(1200), F.lit(0.0))) == 100
    assert one(spark, stock.eoq(F.lit(1200), F.lit(100.0), 0)) == 100
    # sqrt(2 * 6.25 * 500 / 1000) = 2.5 rounds to the even neighbour
    assert one(spark, stock.eoq(F.lit(6.25), F.lit(4000.0))) == 2


def test_levels(spark):
    assert one(spark, stock.safety_stock(F.lit(10.0), F.lit(4))) == 33
    assert one(spark, stock.safety_stock(F.lit(10.0), F.lit(4), 0.99)) == 47
    assert one(spark, stock.safety_stock(F.lit(10.0), F.lit(4), 0.5)) == 33
    assert one(spark, stock.safety_stock(F.lit(0.0), F.lit(4))) == 0
    assert one(spark, stock.reorder_point(F.lit(2.5), F.lit(3), F.lit(4))) == 12
    assert one(spark, stock.days_of_supply(F.lit(10), F.lit(0.0))) == 999.0
    assert one(spark, stock.days_of_supply(F.lit(10), F.lit(3.0))) == 3.3


def test_risk_and_priority(spark):
    assert one(spark, stock.stockout_risk(F.lit(7.0), F.lit(7))) == 0.3679
    assert one(spark, stock.stockout_risk(F.lit(7.0), F.lit(0))) == 0.0
    assert one(spark, stock.stockout_risk(F.lit(0.0), F.lit(3))) == 1.0
    assert [one(spark, stock.priority(F.lit(x))) for x in (4.9, 5.0, 13.9, 14.0)] == ["critical", "warning", "warning", "healthy"]


def test_recommended_order(spark):
    pick = lambda q, r, s, ss: one(spark, stock.recommended_order(F.lit(q), F.lit(r), F.lit(s), F.lit(ss)))
    assert pick(10, 50, 20, 5) == 35
    assert pick(100, 50, 20, 5) == 100
    assert pick(10, 50, 50, 5) == 10


def test_zero_counts_as_missing(spark):
    rows = spark.createDataFrame([(None,), (0.0,), (3.0,)], "x double")
    assert [r[0] for r in rows.select(fx.or_default("x", 7.0)).collect()] == [7.0, 7.0, 3.0]


def test_defaults_in_the_plan(spark):
    base = spark.createDataFrame(
        [("A", None, None, None, None, None, None), ("B", 0.0, 0.0, 0, 0, 0, Decimal(0))],
        "sku_id string, avg_demand double, std_demand double, annual_demand long, quantity_on_hand long, lead_time_days int, "
        "unit_cost_inr decimal(10,2)")
    rows = restock.restock_metrics(base).collect()
    for r in rows:
        assert (r.avg_d, r.std_d, r.lead_time_days, r.current_stock, r.unit_cost, r.annual_d) == (1.0, 0.2, 7, 0, 100.0, 365.0)
        assert r.priority == "critical" and r.safety_stock == 1 and r.reorder_point == 8


def _inventory(spark, rows):
    full = [(s, w, r, d, q, 0, 0, 10, 7, Decimal("100.00")) for s, w, r, d, q in rows]
    return spark.createDataFrame(full, schemas.INVENTORY)


def test_plan_sums_warehouses_filters_and_breaks_ties(spark):
    as_of = dt.date(2023, 4, 1)
    sales = sales_rows(spark, [10] * 90, "B").unionByName(sales_rows(spark, [10] * 90, "A")).unionByName(sales_rows(spark, [10] * 90, "OFF"))
    y = as_of - dt.timedelta(days=1)
    inv = _inventory(spark, [(s, w, "R", y, 10) for s in ("A", "B", "OFF") for w in ("W1", "W2")] + [("A", "W1", "R", as_of, 999)])
    products = spark.createDataFrame(
        [(s, s, "C", None, None, Decimal(1), Decimal(1), None, s != "OFF") for s in ("A", "B", "OFF")], schemas.PRODUCTS)
    plan = restock.restock_plan(sales, inv, products, as_of).collect()
    assert [r.sku_id for r in plan] == ["A", "B"]
    assert plan[0].current_stock == 20 and plan[0].days_of_supply == 2.0 and plan[0].priority == "critical"
    assert len(restock.restock_plan(sales, inv, products, as_of, limit=1).collect()) == 1
    assert restock.restock_plan(sales, inv, products, as_of, priority="healthy").count() == 0
    assert restock.restock_plan(sales, inv, products, as_of, category="X").count() == 0


def test_summary_bounds(spark):
    """Exactly 14 days of supply is a warning here and healthy in the plan."""
    as_of = dt.date(2023, 4, 1)
    sales = sales_rows(spark, [1] * 89)
    y = as_of - dt.timedelta(days=1)
    inv = _inventory(spark, [("A", f"W{q}", "R", y, q) for q in (4, 5, 14, 15)])
    r = restock.stockout_risk_summary(sales, inv, as_of).first()
    assert (r.critical_count, r.warning_count, r.healthy_count) == (1, 2, 1)
