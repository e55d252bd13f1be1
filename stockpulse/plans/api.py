"""Public functions, one per endpoint: arguments are checked before anything is planned."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..functions.scalar import optional_equals
from ..operators import (anomaly, boosting, causal, clustering, forecasting, kpis, monitoring, promotions, restock)
from ..operators.features import build_features, two_sigma_flags
from ..schemas import SERIES_KEYS
from ..session import attach_row
from ..sources.model_store import ModelStore
from ..sources.retail import RetailTables
from ..sources.tables import load_sku_history
from . import forecast_jobs

#: Accepted model names and the member each one selects.
MODELS = {"ensemble": "ensemble", "seasonal": "seasonal", "boosted": "boosted", "lookback": "lookback",
          "prophet": "seasonal", "xgboost": "boosted", "lstm": "lookback"}
PRIORITIES = ("critical", "warning", "healthy")
PROMO_TYPES = ("discount", "bogo", "bundle", "loyalty")


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def forecast_members(sales: DataFrame, as_of, horizon: int, model: PipelineModel | None = None, full: DataFrame | None = None,
                     **gbt_params) -> DataFrame:
    """Seasonal, boosted and lookback columns; a series too short for the lookback uses the boosted value.

    ``full`` is the whole history where ``sales`` is a part of it: the boosted model is fitted and served on
    the same features of it.
    """
    on = [*SERIES_KEYS, "date"]
    full = sales if full is None else full
    model = model or boosting.fit_gbt(full, as_of, horizon, **gbt_params)
    boosted = boosting.gbt_forecast(model, full, horizon)
    members = (forecasting.seasonal_forecast(forecasting.seasonal_params(sales), horizon)
               .join(boosted, on, "left")
               .join(forecasting.lookback_forecast(forecasting.lookback_params(sales), horizon), on, "left"))
    return members.withColumn("lookback", F.coalesce("lookback", "boosted"))


def forecast(tables: RetailTables, sku_id: str | None = None, region: str | None = None, horizon_days: int = 90,
             model: str = "ensemble", include_ci: bool = True, weights: dict | None = None, days_back: int = 365,
             boosted_model: PipelineModel | None = None, **gbt_params) -> DataFrame:
    """One row per series and future day; every series at once when no key is given.

    The boosted model is shared: it is fitted on all series even when one series is asked for.
    """
    _require(7 <= horizon_days <= 365, "horizon_days must be 7 to 365")
    _require(model in MODELS, f"model must be one of {sorted(MODELS)}")
    history = load_sku_history(tables.sales, tables.as_of, sku_id, region, days_back)
    member = MODELS[model]
    if member == "seasonal":
        rows = forecasting.seasonal_forecast(forecasting.seasonal_params(history), horizon_days)
    else:
        if boosted_model is None:
            boosted_model = boosting.fit_gbt(tables.sales, tables.as_of, horizon_days, **gbt_params)
        asked = optional_equals(tables.sales, sku_id=sku_id, region=region)
        rows = forecast_members(history, tables.as_of, horizon_days, boosted_model, full=asked)
    return forecasting.ensemble(rows, weights, member, include_ci).withColumn("model_used", F.lit(model))


def forecast_response(tables: RetailTables, points: DataFrame, horizon_days: int, holdout_days: int = 30, model: str = "seasonal",
                      version: str = "unpublished", weights: dict | None = None, **gbt_params) -> DataFrame:
    """One nested record per series: ordered points, holdout errors and seasonal components.

    A list holds at most 365 points. Errors are those of ``model``, the member that the points are of, fitted
    without the last ``holdout_days`` days. A stored version has them measured already: :func:`serve_response`.
    """
    _require(model in MODELS, f"model must be one of {sorted(MODELS)}")
    member = MODELS[model]
    held = forecast_jobs.holdout(tables.sales, tables.as_of, holdout_days, member in ("ensemble", "boosted"), weights, **gbt_params)
    errors = kpis.forecast_errors(held.withColumn("predicted", F.col(member)), SERIES_KEYS).select(*SERIES_KEYS, F.round("mape", 2).alias("mape"), F.round("rmse", 2).alias("rmse"))
    strength = forecasting.seasonal_strength(tables.sales)
    parts = strength.select(*SERIES_KEYS, F.struct("weekly_amplitude", "monthly_amplitude", "trend_slope_per_day").alias("seasonal_components"))
    point = F.struct(fx.date_text("date").alias("date"), "predicted_demand", "lower_bound", "upper_bound", "model_used")
    lists = points.groupBy(*SERIES_KEYS).agg(F.sort_array(F.collect_list(point)).alias("forecast"))
    return (lists.join(errors, SERIES_KEYS, "left").join(parts, SERIES_KEYS, "left")
            .select(*SERIES_KEYS, F.lit(str(tables.as_of)).alias("generated_at"), F.lit(horizon_days).alias("horizon_days"),
                    "forecast", "mape", "rmse", F.lit(version).alias("model_version"), "seasonal_components"))


def serve_forecast(store: ModelStore, sku_id: str | None = None, region: str | None = None, horizon_days: int = 90, model: str = "ensemble",
                   include_ci: bool = True, weights: dict | None = None, as_of=None, number: int | None = None, name: str = "forecast") -> DataFrame:
    """Forecast of a published version, the newest by default; nothing is fitted and no sales are read."""
    _require(7 <= horizon_days <= 365, "horizon_days must be 7 to 365")
    _require(model in MODELS, f"model must be one of {sorted(MODELS)}")
    return forecast_jobs.serve(store.get(name, as_of, number), horizon_days, MODELS[model], sku_id, region, weights, include_ci)


def serve_response(store: ModelStore, horizon_days: int = 90, model: str = "ensemble", as_of=None, name: str = "forecast", **options) -> DataFrame:
    """:func:`serve_forecast` as nested records with the errors of the member returned."""
    rows = serve_forecast(store, horizon_days=horizon_days, model=model, as_of=as_of, name=name, **options)
    return forecast_jobs.respond(store.get(name, as_of, options.get("number")), rows, MODELS[model])


def restock_plan(tables: RetailTables, region: str | None = None, category: str | None = None, priority: str | None = None,
                 limit: int = 50, service_level: float = 0.95) -> DataFrame:
    _require(priority is None or priority in PRIORITIES, f"priority must be one of {PRIORITIES}")
    _require(1 <= limit <= 500, "limit must be 1 to 500")
    return restock.restock_plan(tables.sales, tables.inventory, tables.products, tables.as_of, region=region, category=category,
                                priority=priority, limit=limit, service_level=service_level)


def detect_anomalies(tables: RetailTables, days_back: int = 30, region: str | None = None, sku_id: str | None = None,
                     min_score: float = 0.70, scope: str = "series", **options) -> DataFrame:
    _require(1 <= days_back <= 180, "days_back must be 1 to 180")
    _require(0.0 <= min_score <= 1.0, "min_score must be 0 to 1")
    return anomaly.detect_anomalies(tables.sales, tables.weather, tables.competitor, tables.inventory, tables.as_of,
                                    days_back=days_back, region=region, sku_id=sku_id, min_score=min_score, scope=scope, **options)


def feature_matrix(tables: RetailTables, days: int = 90, min_rows: int = 30) -> DataFrame:
    lift = promotions.promo_lift(tables.sales, tables.promotions)
    return clustering.sku_feature_matrix(tables.sales, tables.products, kpis.return_rates(tables.sales), lift, tables.as_of, days, min_rows)


def sku_clusters(tables: RetailTables, n_clusters: int | None = 4, features: str = "velocity,margin,volume,seasonality", **matrix) -> DataFrame:
    _require(n_clusters is None or 2 <= n_clusters <= 10, "n_clusters must be 2 to 10")
    return clustering.sku_clusters(feature_matrix(tables, **matrix), n_clusters, features.split(","))


def regional_kpis(tables: RetailTables, start: str | None = None, end: str | None = None) -> DataFrame:
    """Period totals; the trailing 30 days by default."""
    first = fx.as_day(start) if start else tables.as_of - dt.timedelta(days=30)
    last = fx.as_day(end) if end else tables.as_of
    _require(first <= last, "start must not be after end")
    daily = kpis.sku_daily_kpis(fx.from_day(tables.sales, first), fx.from_day(tables.forecasts, first, "target_date"),
                                fx.from_day(tables.inventory, first, "snapshot_date"))
    return kpis.regional_kpis(kpis.regional_daily_kpis(daily), first, last)


def promo_impact(tables: RetailTables, sku_ids: list[str], start: str, end: str, promo_type: str = "discount",
                 discount_pct: float | None = None, regions: list[str] | None = None, decay_days: int = 14,
                 matched: bool = False, **matrix) -> dict[str, DataFrame]:
    """Lift, elasticity, decay, cannibalization and spike attribution of one campaign."""
    _require(bool(sku_ids), "sku_ids must not be empty")
    _require(fx.as_day(start) <= fx.as_day(end), "start must not be after end")
    _require(promo_type in PROMO_TYPES, f"promotion_type must be one of {PROMO_TYPES}")
    spark = tables.spark
    controls = None
    if matched:  # treated SKUs without a control add none
        treated = spark.createDataFrame([(s,) for s in sku_ids], "sku_id string")
        pairs = causal.match_controls(clustering.cluster_skus(feature_matrix(tables, **matrix)), treated)
        controls = pairs.filter("control_sku_id IS NOT NULL").select(F.col("control_sku_id").alias("sku_id"))
    campaign = spark.createDataFrame(
        [("request", promo_type, promo_type, None, fx.as_day(start), fx.as_day(end), sku_ids, regions)],
        "promo_id string, name string, promo_type string, discount_pct double, start_date date, end_date date, "
        "applicable_skus array<string>, applicable_regions array<string>")
    spikes = two_sigma_flags(tables.sales).filter(F.col("outside") & F.col("sku_id").isin(*sku_ids)
                                                  & F.col("date").between(F.lit(fx.as_day(start)), F.lit(fx.as_day(end))))
    reach = (fx.as_day(end) - fx.as_day(start)).days + 400
    full = build_features(tables.sales, tables.weather, tables.competitor, end, lookback=reach)
    return {
        "lift": promotions.did_lift(tables.sales, sku_ids, start, end, promo_type, discount_pct, regions, controls),
        "decay": promotions.promo_decay(tables.sales, campaign, decay_days).drop("promo_id"),
        "cannibalization": promotions.cannibalization(tables.sales, tables.products, sku_ids, start, end),
        "attribution": causal.attribute_spikes(full, spikes, ["sku_id", "region", "date"]),
    }


def portfolio_kpis(tables: RetailTables, window_days: int = 30, anomalies: DataFrame | None = None) -> DataFrame:
    """One row: errors, stockouts and their change, turnover, saving, coverage, anomalies, drift alerts."""
    _require(window_days >= 1, "window_days must be positive")
    drift = monitoring.psi(tables.sales, tables.as_of)
    out = kpis.portfolio_kpis(tables.sales, tables.forecasts, tables.inventory, tables.products, tables.as_of, window_days,
                              anomalies, drift)
    span = 2 * window_days
    daily = kpis.sku_daily_kpis(fx.trailing(tables.sales, tables.as_of, span), fx.trailing(tables.forecasts, tables.as_of, span, "target_date"),
                                fx.trailing(tables.inventory, tables.as_of, span, "snapshot_date"))
    change = kpis.stockout_reduction(daily, tables.as_of, window_days).agg(
        fx.pct(F.sum("baseline_stockouts") - F.sum("current_stockouts"), F.sum("baseline_stockouts")).alias("stockout_reduction_pct"))
    return attach_row(out, change)
