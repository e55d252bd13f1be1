"""Training, publishing and serving of forecast models: fitting happens in a job, serving opens stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..operators import boosting, conformal, forecasting, kpis
from ..schemas import SERIES_KEYS
from ..session import stage
from ..sources.model_store import ModelStore, Version

MEMBERS = ("seasonal", "boosted", "lookback")
HOLDOUT_DAYS = 28


def fitted(sales: DataFrame, as_of, horizon: int, boosted: bool = True, **gbt_params) -> tuple[dict, dict]:
    """(tables, pipelines) that serving needs: parameters of every series and the shared boosted model."""
    tables = {"seasonal": forecasting.seasonal_params(sales), "lookback": forecasting.lookback_params(sales)}
    if not boosted:
        return tables, {}
    return {**tables, "origins": boosting.newest_origins(sales)}, {"boosted": boosting.fit_gbt(sales, as_of, horizon, **gbt_params)}


def points(tables: dict, pipelines: dict, horizon: int, weights: dict | None = None, last_day=None) -> DataFrame:
    """keys, date, the members, their bounds and ``ensemble``; a series without lookback uses the boosted value.

    With ``last_day`` the closed-form members start the day after it, also for a series that ended before.
    """
    on = [*SERIES_KEYS, "date"]
    start = (lambda p: p) if last_day is None else (lambda p: p.withColumn("last_date", F.lit(last_day).cast("date")))
    rows = forecasting.seasonal_forecast(start(tables["seasonal"]), horizon).join(
        forecasting.lookback_forecast(start(tables["lookback"]), horizon), on, "left")
    if pipelines:
        rows = rows.join(boosting.serve_gbt(pipelines["boosted"], tables["origins"], horizon), on, "left").withColumn("lookback", F.coalesce("lookback", "boosted"))
    return rows.withColumn("ensemble", forecasting.weighted_mean(rows.columns, weights))


def holdout(sales: DataFrame, as_of: dt.date, days: int = HOLDOUT_DAYS, boosted: bool = True, weights: dict | None = None, **gbt_params) -> DataFrame:
    """keys, date, actual and every member for the last ``days`` days, fitted on the days before only."""
    cutoff = as_of - dt.timedelta(days=days)
    train = sales.filter(F.col("date") <= F.lit(cutoff))
    if boosted:
        train = stage(train, "holdout-train")
    rows = points(*fitted(train, cutoff, days, boosted, **gbt_params), days, weights, cutoff)
    actual = sales.filter((F.col("date") > F.lit(cutoff)) & (F.col("date") <= F.lit(as_of))).select(*SERIES_KEYS, "date", F.col("sales_qty").alias("actual"))
    return actual.join(rows.drop("lower_bound", "upper_bound"), [*SERIES_KEYS, "date"], "left")


def member_errors(held: DataFrame, keys=()) -> DataFrame:
    """Errors of each member that ``held`` has: member, keys, rows, mape, rmse, wape, bias."""
    known = [m for m in (*MEMBERS, "ensemble") if m in held.columns]
    long = held.select(*keys, "actual", F.explode(F.create_map(*[x for m in known for x in (F.lit(m), F.col(m).cast("double"))])).alias("member", "predicted"))
    return kpis.forecast_errors(long, ["member", *keys])


def backtest(sales: DataFrame, as_of: dt.date, folds: int = 3, horizon: int = 28, **options) -> DataFrame:
    """Walk-forward errors of every member and of the ensemble: fold, member, rows, mape, rmse, wape, bias.

    Fold k is fitted on the days up to ``as_of - k * horizon`` and tested on the ``horizon`` days after them.
    """
    out = None
    for k in range(1, folds + 1):
        upto = as_of - dt.timedelta(days=(k - 1) * horizon)
        errors = stage(member_errors(holdout(sales.filter(F.col("date") <= F.lit(upto)), upto, horizon, **options)).withColumn("fold", F.lit(k)), "fold-errors")
        out = errors if out is None else out.unionByName(errors)
    return out


def train(sales: DataFrame, as_of: dt.date, store: ModelStore, name: str = "forecast", horizon: int = 90, holdout_days: int = HOLDOUT_DAYS,
          boosted: bool = True, coverage: float = conformal.COVERAGE, weights: dict | None = None, **gbt_params) -> Version:
    """Fit without the last days to measure errors and interval widths, fit on everything, publish as one version."""
    cutoff = as_of - dt.timedelta(days=holdout_days)
    held = stage(holdout(sales, as_of, holdout_days, boosted, weights, **gbt_params), "holdout")
    levels = conformal.series_level(sales.filter(F.col("date") <= F.lit(cutoff)))
    members = [m for m in (*MEMBERS, "ensemble") if m in held.columns]
    tables, pipelines = fitted(sales, as_of, horizon, boosted, **gbt_params)
    figures = {r.member: {"mape": r.mape, "rmse": r.rmse, "rows": r.rows} for r in member_errors(held).collect()}  # one row a member
    return store.publish(name, as_of, pipelines=pipelines, metrics=figures, tables={
        **tables, "levels": conformal.series_level(sales), "widths": conformal.calibrate(held, levels, cutoff, members, coverage),
        "errors": member_errors(held, SERIES_KEYS), "strength": forecasting.seasonal_strength(sales)})


def serve(version: Version, horizon: int, member: str = "ensemble", sku_id: str | None = None, region: str | None = None,
          weights: dict | None = None, include_ci: bool = True) -> DataFrame:
    """keys, date, predicted_demand, lower_bound, upper_bound, model_used, model_version from stored tables alone.

    No sales are read and nothing is fitted; the keys reach the scans. Intervals are the calibrated ones of the member.
    """
    wanted = {"sku_id": sku_id, "region": region}
    tables = {t: fx.optional_equals(version.table(t), **wanted) for t in ("seasonal", "lookback", "origins", "levels") if t in version.schemas}
    pipelines = {"boosted": version.pipeline("boosted")} if "origins" in tables else {}
    if member == "boosted" and not pipelines:
        raise ValueError(f"version {version.number} has no boosted model")
    rows = points(tables, pipelines, horizon, weights).select(*SERIES_KEYS, "date", F.col(member).alias("predicted_demand"), "lower_bound", "upper_bound")
    if include_ci:
        rows = conformal.with_intervals(rows, version.table("widths"), tables["levels"], version.as_of, member)
    else:
        rows = rows.withColumns({c: F.lit(None).cast("double") for c in ("lower_bound", "upper_bound")})
    rounded = {c: F.round(c, 1) for c in ("predicted_demand", "lower_bound", "upper_bound")}
    return rows.withColumns(rounded).withColumns({"model_used": F.lit(member), "model_version": F.lit(version.number)})


def respond(version: Version, rows: DataFrame, member: str) -> DataFrame:
    """One nested record per series: ordered points, the errors of the member returned, seasonal components."""
    errors = version.table("errors").filter(F.col("member") == member).select(*SERIES_KEYS, F.round("mape", 2).alias("mape"), F.round("rmse", 2).alias("rmse"))
    parts = version.table("strength").select(*SERIES_KEYS, F.struct("weekly_amplitude", "monthly_amplitude", "trend_slope_per_day").alias("seasonal_components"))
    point = F.struct(fx.date_text("date").alias("date"), "predicted_demand", "lower_bound", "upper_bound", "model_used")
    lists = rows.groupBy(*SERIES_KEYS).agg(F.sort_array(F.collect_list(point)).alias("forecast"), F.count("*").alias("horizon_days"))
    return lists.join(errors, SERIES_KEYS, "left").join(parts, SERIES_KEYS, "left").withColumns(
        {"generated_at": F.lit(version.as_of), "model_version": F.lit(str(version.number))})
