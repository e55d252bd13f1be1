"""Daily, regional and portfolio indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions import scalar as fx
from ..functions import stock
from ..schemas import FACT_KEYS, SERIES_KEYS
from ..session import attach_row
from .features import two_sigma_flags
from .restock import inventory_by_region


def latest_forecast(forecasts: DataFrame, model: str | None = "ensemble") -> DataFrame:
    """Newest vintage per (sku, region, target date): ``max_by`` combines map-side, a ranking would not."""
    chosen = fx.optional_equals(forecasts, model_name=model)
    return chosen.groupBy("sku_id", "region", F.col("target_date").alias("date")).agg(
        F.max_by(F.col("predicted_qty").cast("double"), "forecast_date").alias("predicted_qty"))


def sku_daily_kpis(sales: DataFrame, forecasts: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per (sku, region, date); both right sides are reduced to that key before joining."""
    on_hand, rop = F.col("quantity_on_hand"), F.col("rop")
    stock_rows = inventory_by_region(inventory).select(*FACT_KEYS, "quantity_on_hand", F.col("reorder_point").alias("rop"))
    return (
        sales.join(latest_forecast(forecasts), FACT_KEYS, "left").join(stock_rows, FACT_KEYS, "left")
        .select(
            *FACT_KEYS, F.col("sales_qty").alias("actual_sales"), F.col("predicted_qty").alias("predicted_demand"),
            F.round(fx.abs_pct_error("sales_qty", "predicted_qty"), 3).alias("mape"),
            F.when(on_hand == 0, 1).otherwise(0).alias("stockout_events"),
            F.when(on_hand > rop * 2, 1).otherwise(0).alias("overstock_events"),
            F.coalesce(on_hand, F.lit(0)).alias("stock_level"), F.coalesce(rop, F.lit(0)).alias("reorder_point"),
            "is_promotion", "promo_id",
        )
    )


def regional_daily_kpis(kpis: DataFrame) -> DataFrame:
    return kpis.groupBy("region", "date").agg(
        F.sum("actual_sales").alias("total_sales"), F.sum("predicted_demand").alias("total_predicted_demand"),
        F.avg("mape").alias("avg_mape"), (F.lit(100.0) - F.avg("mape")).alias("forecast_accuracy_pct"),
        F.sum("stockout_events").alias("stockout_events"), F.sum("overstock_events").alias("overstock_events"),
        F.round((F.lit(1.0) - F.sum("stockout_events") / F.count(F.lit(1))) * 100, 2).alias("fulfillment_rate"))


def regional_kpis(regional_daily: DataFrame, start, end) -> DataFrame:
    """Period totals per region, largest sales first."""
    return (
        regional_daily.filter(F.col("date").between(F.lit(start), F.lit(end))).groupBy("region").agg(
            F.sum("total_sales").alias("total_sales"), F.sum("total_predicted_demand").alias("predicted_demand"),
            F.avg("avg_mape").alias("avg_mape"), F.avg("forecast_accuracy_pct").alias("forecast_accuracy_pct"),
            F.sum("stockout_events").alias("stockout_events"), F.sum("overstock_events").alias("overstock_events"),
            F.avg("fulfillment_rate").alias("fulfillment_rate_pct"))
        .orderBy(F.desc("total_sales"), "region")
    )


def inventory_turnover(sales: DataFrame, inventory: DataFrame, products: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Cost of goods sold over average stock value, annualised, per region."""
    cost = products.select("sku_id", F.col("unit_cost_inr").cast("double").alias("cost"))
    sold = (fx.trailing(sales, as_of, days - 1).join(cost, "sku_id").groupBy("region")
            .agg(F.sum(F.col("sales_qty") * F.col("cost")).alias("cogs")))
    value = F.col("quantity_on_hand") * F.col("unit_cost_inr").cast("double")
    held = (fx.trailing(inventory, as_of, days - 1, "snapshot_date").groupBy("region", "snapshot_date")
            .agg(F.sum(value).alias("value")).groupBy("region").agg(F.avg("value").alias("avg_value")))
    return sold.join(held, "region").select(
        "region", "cogs", "avg_value", (fx.ratio("cogs", "avg_value") * 365 / days).alias("inventory_turnover"))


def demand_coverage(sales: DataFrame, inventory: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Share of sales rows covered by the stock of that day, per region; a row without a stock row is not covered."""
    recent = fx.trailing(sales, as_of, days - 1)
    stocked = inventory_by_region(fx.trailing(inventory, as_of, days - 1, "snapshot_date"))
    covered = F.when(F.col("quantity_on_hand") >= F.col("sales_qty"), 1.0).otherwise(0.0)
    return recent.join(stocked.select(*FACT_KEYS, "quantity_on_hand"), FACT_KEYS, "left").groupBy("region").agg(
        F.count(F.lit(1)).alias("demand_events"), (F.avg(covered) * 100).alias("demand_coverage_pct"))


def overstock_saving(sales: DataFrame, products: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Carrying cost avoided by ordering the economic quantity rather than 30 days of demand, per region.

    An order is held for half its size on average; the saving of a series is never negative.
    """
    demand = fx.trailing(sales, as_of, days - 1).groupBy(*SERIES_KEYS).agg(F.avg("sales_qty").alias("avg_demand"))
    cost = products.select("sku_id", F.col("unit_cost_inr").cast("double").alias("cost"))
    naive = F.col("avg_demand") * 30
    best = stock.eoq(F.col("avg_demand") * 365, "cost")
    carrying = F.greatest(F.lit(0.0), naive - best) / 2 * F.col("cost") * stock.HOLDING_PCT * days / 365
    return demand.join(cost, "sku_id").groupBy("region").agg(F.sum(carrying).alias("overstock_cost_saved_inr"))


def stockout_reduction(kpis: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Stockout days of the window against the window before it, per region."""
    current = F.col("date") > F.date_sub(F.lit(as_of), days)
    both = kpis.filter(F.col("date") > F.date_sub(F.lit(as_of), 2 * days)).groupBy("region").agg(
        F.sum(F.when(current, F.col("stockout_events")).otherwise(0)).alias("current_stockouts"),
        F.sum(F.when(~current, F.col("stockout_events")).otherwise(0)).alias("baseline_stockouts"))
    change = fx.pct(F.col("baseline_stockouts") - F.col("current_stockouts"), "baseline_stockouts")
    return both.withColumn("stockout_reduction_pct", change)


def weighted_error(kpis: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Demand-weighted error per region over rows that have a forecast."""
    rows = kpis if as_of is None else fx.trailing(kpis, as_of, days)
    return rows.filter(F.col("predicted_demand").isNotNull()).groupBy("region").agg(
        fx.pct(F.sum(F.abs(F.col("actual_sales") - F.col("predicted_demand"))), F.sum("actual_sales")).alias("wape"),
        F.avg(F.col("predicted_demand") - F.col("actual_sales")).alias("bias"))


def portfolio_kpis(sales: DataFrame, forecasts: DataFrame, inventory: DataFrame, products: DataFrame, as_of,
                   window_days: int = 30, anomalies: DataFrame | None = None, drift: DataFrame | None = None) -> DataFrame:
    """One row for the whole portfolio over the trailing window.

    Each part reduces to per-region rows first, so the final joins see a handful of rows. Without
    given anomalies the two-sigma flags of the window are counted.
    """
    history = F.date_sub(F.lit(as_of), window_days)
    kpis = sku_daily_kpis(fx.trailing(sales, as_of, window_days), fx.trailing(forecasts, as_of, window_days, "target_date"),
                          fx.trailing(inventory, as_of, window_days, "snapshot_date"))
    totals = kpis.agg(
        F.avg("mape").alias("avg_mape"),
        fx.pct(F.sum(F.when(F.col("predicted_demand").isNotNull(), F.abs(F.col("actual_sales") - F.col("predicted_demand")))),
               F.sum(F.when(F.col("predicted_demand").isNotNull(), F.col("actual_sales")))).alias("weighted_mape"),
        F.sum("stockout_events").alias("stockout_events_total"),
        ((F.lit(1.0) - F.sum("stockout_events") / F.count(F.lit(1))) * 100).alias("fulfillment_rate"))
    turnover = inventory_turnover(sales, inventory, products, as_of, window_days).agg(
        (fx.ratio(F.sum("cogs"), F.sum("avg_value")) * 365 / window_days).alias("inventory_turnover"))
    saved = overstock_saving(sales, products, as_of, window_days).agg(
        F.sum("overstock_cost_saved_inr").alias("overstock_cost_saved_inr"))
    coverage = demand_coverage(sales, inventory, as_of, window_days).agg(
        fx.ratio(F.sum(F.col("demand_coverage_pct") * F.col("demand_events")), F.sum("demand_events")).alias("demand_coverage_pct"))
    if anomalies is None:
        anomalies = two_sigma_flags(sales).filter(F.col("outside") & (F.col("date") >= history))
    parts = [totals, turnover, saved, coverage, anomalies.agg(F.count(F.lit(1)).alias("anomalies_detected"))]
    if drift is not None:
        parts.append(drift.agg(F.count_if(F.col("drifted")).alias("model_drift_alerts")))
    return reduce(attach_row, parts)


def monthly_accuracy(kpis: DataFrame) -> DataFrame:
    """max(0, 100 - |a-p|/a*100) on monthly totals, 0 when there is no forecast."""
    monthly = kpis.groupBy(F.trunc("date", "MM").alias("month")).agg(
        F.sum(F.when(F.col("predicted_demand").isNotNull(), F.col("actual_sales"))).alias("actual"),
        F.sum("predicted_demand").alias("predicted"))
    accuracy = F.greatest(F.lit(0.0), F.lit(100.0) - fx.abs_pct_error("actual", "predicted"))
    return monthly.select("month", "actual", "predicted", F.coalesce(accuracy, F.lit(0.0)).alias("accuracy_pct"))


def regional_flags(period: DataFrame) -> DataFrame:
    """Report flags on period totals."""
    return period.select("region", "forecast_accuracy_pct", "stockout_events",
                         labels.good_accuracy("forecast_accuracy_pct").alias("good_accuracy"),
                         labels.many_stockouts("stockout_events").alias("many_stockouts"))


def return_rates(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sku_id").agg(fx.pct(F.sum("returns_qty"), F.sum("sales_qty")).alias("return_rate_pct"))


def uplift_pct(during, baseline):
    return fx.pct(fx._c(during) - fx._c(baseline), baseline)


def forecast_errors(scored: DataFrame, keys=(), actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MAPE (zero actuals ignored), RMSE, WAPE and bias per group."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return scored.filter(p.isNotNull() & a.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(fx.abs_pct_error(a, p)).alias("mape"),
        F.sqrt(F.avg((p - a) * (p - a))).alias("rmse"), fx.pct(F.sum(F.abs(p - a)), F.sum(a)).alias("wape"),
        F.avg(p - a).alias("bias"))


def cluster_distribution(clusters: DataFrame, all_labels=tuple(labels.CLUSTER_STRATEGIES)) -> DataFrame:
    """SKUs per label, absent labels as 0."""
    counts = clusters.groupBy("cluster_label").agg(F.count(F.lit(1)).alias("n"))
    known = clusters.sparkSession.createDataFrame([(x,) for x in all_labels], "cluster_label string")
    return known.join(counts, "cluster_label", "left").select("cluster_label", F.coalesce("n", F.lit(0)).alias("sku_count"))
