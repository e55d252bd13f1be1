"""Batch jobs as plain functions; a scheduler of your choice calls them in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..operators import boosting, clustering, features, forecasting, isolation_forest, kpis, monitoring, quality
from ..schemas import FACT_KEYS
from ..session import stage
from ..sources import sinks
from ..sources.retail import RetailTables
from ..sources.tables import ingest_batch

HOLDOUT_DAYS = 28


def ingest_inventory(raw: DataFrame, day, path: str) -> dict:
    return {"records_synced": sinks.sync_inventory(ingest_batch(raw, day, "snapshot_date"), path)}


def ingest_weather(kelvin: DataFrame, stored: DataFrame) -> DataFrame:
    """New (region, date, score) rows from (region, date, temp_kelvin), none that is stored already."""
    scores = kelvin.select("region", "date", fx.weather_score("temp_kelvin").alias("score"))
    return sinks.append_absent(scores, stored, ["region", "date"])


def run_features(tables: RetailTables, run_date, path: str, lookback: int = 400, mode: str = "rows", days: int = 7) -> int:
    """Build the features of the last ``days`` days and write those days; returns the number of rows written.

    ``lookback`` days are read, so that last year's value and the longest window are there for each day
    that is written. Days that are stored already stay as they are, unless the run covers them.
    """
    if days > lookback - 365:
        raise ValueError("lookback must reach a year beyond the days to write")
    rows = features.build_features(tables.sales, tables.weather, tables.competitor, run_date, lookback, mode)
    return sinks.write_features(fx.trailing(rows, run_date, days - 1), path)


def daily_checks(tables: RetailTables) -> DataFrame:
    """Run the daily checks and fail on any violation."""
    result = quality.report({
        "sales key": quality.duplicate_keys(tables.sales, FACT_KEYS),
        "inventory key": quality.duplicate_keys(tables.inventory, ["sku_id", "warehouse_id", "snapshot_date"]),
        "weather key": quality.duplicate_keys(tables.weather, ["region", "date"]),
        "forecast key": quality.duplicate_keys(tables.forecasts, ["sku_id", "region", "forecast_date", "target_date", "model_name"]),
        "sales product": quality.orphans(tables.sales, tables.products, "sku_id", "sku_id"),
        "sales not null": tables.sales.filter(F.col("sales_qty").isNull() | F.col("revenue_inr").isNull()),
        "promotion type": quality.domain_violations(tables.promotions, F.col("promo_type").isin("discount", "bogo", "bundle", "loyalty")),
        "sku length": quality.domain_violations(tables.sales, quality.max_length("sku_id", 20)),
    })
    quality.enforce(result)
    return result


def refresh_views(tables: RetailTables, path: str) -> None:
    sinks.refresh_views(kpis.sku_daily_kpis(tables.sales, tables.forecasts, tables.inventory), kpis.regional_daily_kpis, path)


def train_all(tables: RetailTables, model: str, train_days: int = 548, **params) -> DataFrame:
    """Errors of one model over every series: fitted on the trailing months, tested on the last 28 days."""
    history = fx.trailing(tables.sales, tables.as_of, train_days)
    if model in ("seasonal", "lookback", "naive"):
        errors = forecasting.backtest(history, tables.as_of, folds=1, horizon=HOLDOUT_DAYS, model=model)
    elif model == "boosted":
        cutoff = F.date_sub(F.lit(tables.as_of), HOLDOUT_DAYS)
        train = stage(history.filter(F.col("date") <= cutoff), "boosted_train")
        fitted = boosting.fit_gbt(train, F.date_sub(F.lit(tables.as_of), HOLDOUT_DAYS), HOLDOUT_DAYS, train_days=train_days, **params)
        actual = history.filter(F.col("date") > cutoff).select(*FACT_KEYS, F.col("sales_qty").alias("actual"))
        scored = boosting.gbt_forecast(fitted, train, HOLDOUT_DAYS).join(actual, FACT_KEYS)
        errors = kpis.forecast_errors(scored, (), "actual", "boosted").withColumn("fold", F.lit(1))
    else:
        raise ValueError(f"unknown model {model!r}")
    return errors.select(F.lit(model).alias("model_name"), F.col("mape").alias("avg_mape"), F.col("rmse").alias("avg_rmse"), "rows")


def train_anomaly_model(tables: RetailTables, days: int = 548) -> isolation_forest.Forest:
    recent = fx.trailing(tables.sales, tables.as_of, days)
    rows = stage(features.detector_features(features.enrich(recent, tables.weather, tables.competitor)), "detector_train")
    return isolation_forest.fit_forest(rows, FACT_KEYS, features.DETECTOR_FEATURES)


def train_clustering(matrix: DataFrame) -> dict:
    scaled, _ = clustering.standardize(stage(matrix, "matrix"), clustering.MATRIX_COLUMNS)
    reduced = clustering.principal_components(scaled, "scaled", len(clustering.MATRIX_COLUMNS))
    k, silhouette = clustering.best_silhouette(reduced)
    return {"n_clusters": k, "silhouette": silhouette}


def check_drift(tables: RetailTables) -> DataFrame:
    return monitoring.psi(tables.sales, tables.as_of).agg(
        F.count(F.lit(1)).alias("total_skus"), F.count_if(F.col("drifted")).alias("drifted"))


def check_accuracy(tables: RetailTables) -> DataFrame:
    """Realized error of yesterday's targets."""
    yesterday = F.date_sub(F.lit(tables.as_of), 1)
    filled = sinks.realize_forecasts(tables.forecasts, tables.sales, tables.as_of)
    return monitoring.realized_mape(filled, yesterday).select(F.round("realized_mape", 3).alias("realized_mape"))
