"""Restock plan and stockout-risk summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..functions import stock
from ..schemas import SERIES_KEYS

RESTOCK_COLUMNS = [
    "sku_id", "region", "category", "current_stock", "reorder_point", "recommended_order_qty", "economic_order_qty",
    "lead_time_days", "days_of_supply", "stockout_risk_score", "priority", "estimated_cost_inr", "safety_stock",
    "annual_demand_units", "avg_daily_demand",
]


def inventory_by_region(inventory: DataFrame) -> DataFrame:
    """Warehouses of a region summed to one row per (sku, region, date)."""
    return inventory.groupBy("sku_id", "region", F.col("snapshot_date").alias("date")).agg(
        F.sum("quantity_on_hand").alias("quantity_on_hand"), F.max("reorder_point").alias("reorder_point"),
        F.max("lead_time_days").alias("lead_time_days"), F.max("unit_cost_inr").alias("unit_cost_inr"))


def demand_stats(sales: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Average, sample deviation and annualised volume of the trailing quarter per series."""
    return fx.trailing(sales, as_of, days).groupBy(*SERIES_KEYS).agg(
        F.avg("sales_qty").alias("avg_demand"), F.stddev_samp("sales_qty").alias("std_demand"),
        (F.sum("sales_qty") * 4).alias("annual_demand"))


def restock_metrics(base: DataFrame, service_level: float = 0.95) -> DataFrame:
    """Formulas over (avg_demand, std_demand, annual_demand, stock, lead_time, unit_cost) rows."""
    avg = fx.or_default(F.col("avg_demand").cast("double"), 1.0)
    filled = base.withColumn("avg_d", avg).withColumns({
        "std_d": fx.or_default(F.col("std_demand").cast("double"), F.col("avg_d") * 0.2),
        "lead_time_days": fx.or_default(F.col("lead_time_days").cast("int"), 7),
        "current_stock": F.coalesce(F.col("quantity_on_hand"), F.lit(0)).cast("long"),
        "unit_cost": fx.or_default(F.col("unit_cost_inr").cast("double"), 100.0),
        "annual_d": fx.or_default(F.col("annual_demand").cast("double"), F.col("avg_d") * 365),
    })
    return (
        filled.withColumns({
            "safety_stock": stock.safety_stock("std_d", "lead_time_days", service_level),
            "economic_order_qty": stock.eoq("annual_d", "unit_cost"),
            "days_of_supply": stock.days_of_supply("current_stock", "avg_d"),
            "annual_demand_units": F.col("annual_d").cast("long"), "avg_daily_demand": F.round("avg_d", 1),
        }).withColumns({
            "reorder_point": stock.reorder_point("avg_d", "lead_time_days", "safety_stock"),
            "stockout_risk_score": stock.stockout_risk("days_of_supply", "lead_time_days"),
            "priority": stock.priority("days_of_supply"),
            "estimated_cost_inr": stock.estimated_cost("economic_order_qty", "unit_cost"),
        }).withColumn("recommended_order_qty",
                      stock.recommended_order("economic_order_qty", "reorder_point", "current_stock", "safety_stock"))
    )


def restock_plan(sales: DataFrame, inventory: DataFrame, products: DataFrame, as_of, *, region: str | None = None,
                 category: str | None = None, priority: str | None = None, limit: int | None = 50,
                 service_level: float = 0.95) -> DataFrame:
    """Ranked restock recommendations, one row per active (sku, region).

    Every side is reduced to the series key before the join, filters sit on the scans, and the
    ranking is a distributed top-k.
    """
    snapshot = fx.optional_equals(inventory.filter(F.col("snapshot_date") == F.date_sub(F.lit(as_of), 1)), region=region)
    stocked = inventory_by_region(snapshot).drop("date", "reorder_point")
    active = fx.optional_equals(products.filter("is_active"), category=category).select("sku_id", "category")
    demand = demand_stats(fx.optional_equals(sales, region=region), as_of)
    plan = restock_metrics(stocked.join(active, "sku_id").join(demand, SERIES_KEYS), service_level)
    plan = fx.optional_equals(plan, priority=priority).select(*RESTOCK_COLUMNS)
    if limit is None:
        return plan
    return plan.orderBy(stock.priority_rank("priority"), F.desc("stockout_risk_score"), "sku_id", "region").limit(limit)


def stockout_risk_summary(sales: DataFrame, inventory: DataFrame, as_of, region: str | None = None) -> DataFrame:
    """Warehouse rows per region by days of supply: below 5, 5 to 14, above 14."""
    daily = fx.trailing(sales, as_of, 30).groupBy(*SERIES_KEYS).agg(F.avg("sales_qty").alias("avg_daily"))
    snapshot = fx.optional_equals(inventory.filter(F.col("snapshot_date") == F.date_sub(F.lit(as_of), 1)), region=region)
    supply = fx.ratio("quantity_on_hand", "avg_daily")
    return (
        snapshot.join(daily, SERIES_KEYS).withColumn("supply", supply).groupBy("region").agg(
            F.count_if(F.col("supply") < 5).alias("critical_count"),
            F.count_if(F.col("supply").between(5, 14)).alias("warning_count"),
            F.count_if(F.col("supply") > 14).alias("healthy_count"))
    )
