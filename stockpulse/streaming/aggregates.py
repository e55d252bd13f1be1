"""Streaming aggregates and alerts. Append mode: a window is emitted once, after the watermark passed it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALERT_SCORE = 0.9


def daily_sales(events: DataFrame) -> DataFrame:
    """Events to sku x region x day. Partial sums are combined per task before the shuffle."""
    return (
        events.groupBy(F.window("ts", "1 day"), "sku_id", "region")
        .agg(F.sum("qty").alias("sales_qty"), F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("events"))
    )


def flat_days(daily: DataFrame) -> DataFrame:
    return daily.select("sku_id", "region", F.col("window.start").cast("date").alias("date"), "sales_qty", "revenue", "events")


def rolling_stats(daily: DataFrame) -> DataFrame:
    """Mean and deviation of the daily totals in sliding windows of 7 days, moved by 1 day."""
    return (
        daily.withColumn("at", F.window_time("window")).groupBy(F.window("at", "7 days", "1 day"), "sku_id", "region")
        .agg(F.avg("sales_qty").alias("rolling_mean_7"), F.stddev_samp("sales_qty").alias("rolling_std_7"),
             F.count(F.lit(1)).alias("days"))
        .select("sku_id", "region", F.col("window.start").cast("date").alias("from_date"), "rolling_mean_7", "rolling_std_7", "days")
    )


def enriched(days: DataFrame, products: DataFrame) -> DataFrame:
    """Stream-static join with the product table."""
    facts = products.select("sku_id", "category", F.col("unit_cost_inr").cast("double").alias("unit_cost_inr"))
    return days.join(facts, "sku_id").withColumn("cogs", F.col("sales_qty") * F.col("unit_cost_inr"))


def baseline(daily_history: DataFrame) -> DataFrame:
    """Static mean and deviation per series."""
    return daily_history.groupBy("sku_id", "region").agg(
        F.avg("sales_qty").alias("mean_qty"), F.stddev_samp("sales_qty").alias("std_qty"))


def surprise(value: Column, mean: Column, std: Column) -> Column:
    """1 - exp(-z^2/2): 0 at the mean, above 0.9 beyond 2.15 deviations; 0 without a deviation."""
    z = (value - mean) / F.nullif(std, F.lit(0.0))
    return F.coalesce(F.lit(1.0) - F.exp(-z * z / 2), F.lit(0.0))


def alerts(days: DataFrame, history: DataFrame, threshold: float = ALERT_SCORE) -> DataFrame:
    """Days whose total is far from the history of their series. Scored against a static table, so the
    stream keeps no state per series."""
    scored = days.join(history, ["sku_id", "region"]).withColumn(
        "anomaly_score", surprise(F.col("sales_qty"), F.col("mean_qty"), F.col("std_qty")))
    return scored.filter(F.col("anomaly_score") > threshold).select(
        "sku_id", "region", "date", F.col("sales_qty").cast("double").alias("actual_value"), "anomaly_score")


def forecast_monitoring(events: DataFrame, width: str = "7 days", delay: str = "1 day") -> DataFrame:
    """Mean error per model and window of the forecast events."""
    return (
        events.withWatermark("ts", delay).groupBy(F.window("ts", width), "model")
        .agg(F.avg("mape").alias("avg_mape"), F.count(F.lit(1)).alias("forecasts"))
        .select("model", F.col("window.start").cast("date").alias("week"), "avg_mape", "forecasts")
    )


def latest_stock(updates: DataFrame) -> DataFrame:
    """Newest quantity per (sku, warehouse) in a batch of updates; ties by the larger quantity."""
    return updates.groupBy("sku_id", "warehouse_id").agg(
        F.max(F.struct("ts", "quantity_on_hand")).alias("_last")).select(
        "sku_id", "warehouse_id", F.col("_last.ts").alias("ts"), F.col("_last.quantity_on_hand").alias("quantity_on_hand"))
