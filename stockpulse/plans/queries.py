"""Registered queries: each takes (session, source folder) and returns a DataFrame.

A query loads the retail tables, calls one operator and rounds its doubles, so that the values can be
compared with another engine that adds them up in another order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..functions import scalar as fx
from ..operators import (anomaly, boosting, causal, clustering, conformal, features, forecasting, kpis, monitoring, promotions, quality,
                         restock, search, simplex)
from ..session import scratch_path, stage
from ..sources import ingest, retail, sinks
from ..sources.model_store import ModelStore
from ..streaming import aggregates, events, stateful
from ..streaming.sinks import current_stock, drain, stock_log
from . import api, forecast_jobs, incremental, jobs

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, *only: str) -> DataFrame:
    """Round the double columns (or the named ones); adding 0.0 turns -0.0 into 0.0."""
    names = only or [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({n: F.round(F.col(n), digits) + F.lit(0.0) for n in names}) if names else df


def _history_days(t) -> int:
    """Days from the first to the newest day of the fact."""
    return (t.as_of - t.sales.agg(F.min("date")).first()[0]).days


def _promo_free(df: DataFrame) -> DataFrame:
    return df.drop("promo_id")


# ---- restock -------------------------------------------------------------------------------------

@register
def restock_plan(spark, root):
    t = retail.load(spark, root)
    return restock.restock_plan(t.sales, t.inventory, t.products, t.as_of, limit=500)


@register
def restock_plan_99(spark, root):
    """99 % service level over every series, unranked."""
    t = retail.load(spark, root)
    return restock.restock_plan(t.sales, t.inventory, t.products, t.as_of, limit=None, service_level=0.99)


@register
def restock_critical(spark, root):
    t = retail.load(spark, root)
    return restock.restock_plan(t.sales, t.inventory, t.products, t.as_of, priority="critical", limit=500)


@register
def restock_filtered(spark, root):
    """Every optional argument set."""
    t = retail.load(spark, root)
    return restock.restock_plan(t.sales, t.inventory, t.products, t.as_of, region="ASIA", priority="warning",
                                category="Apparel", limit=20)


@register
def stockout_risk_summary(spark, root):
    t = retail.load(spark, root)
    return restock.stockout_risk_summary(t.sales, t.inventory, t.as_of)


# ---- features ------------------------------------------------------------------------------------

@register
def features_rows(spark, root):
    t = retail.load(spark, root)
    return rounded(features.build_features(t.sales, t.weather, t.competitor, t.as_of))


@register
def features_calendar(spark, root):
    t = retail.load(spark, root)
    return rounded(features.build_features(t.sales, t.weather, t.competitor, t.as_of, mode="calendar", min_periods="full"))


@register
def yoy_ratio(spark, root):
    t = retail.load(spark, root)
    return rounded(t.sales.select("sku_id", "region", "date", "sales_qty", features.yoy_ratio().alias("yoy_ratio"))
                   .filter(F.col("yoy_ratio").isNotNull()))


@register
def forecaster_features(spark, root):
    t = retail.load(spark, root)
    return rounded(features.forecaster_features(t.sales))


@register
def anomaly_features(spark, root):
    t = retail.load(spark, root)
    full = features.detector_features(features.enrich(t.sales, t.weather, t.competitor))
    return rounded(full.select("sku_id", "region", "date", *features.DETECTOR_FEATURES, "series_rows"))


@register
def two_sigma_flags(spark, root):
    t = retail.load(spark, root)
    flags = features.two_sigma_flags(t.sales).filter("outside")
    return rounded(flags.select("sku_id", "region", "date", "sales_qty", "band_mean", "band_std"))


@register
def inventory_drop(spark, root):
    t = retail.load(spark, root)
    return rounded(features.inventory_drop(restock.inventory_by_region(t.inventory)))


# ---- feeds and incremental views -------------------------------------------------------------------

#: Lines with this tax are delivered with a quantity of -1: a feed has rows to refuse.
REFUSED_TAX = 0.08


def _pos_lines(lines: DataFrame) -> DataFrame:
    """Order lines as the till would deliver them, one row a line."""
    qty = F.when(F.col("l_tax") == REFUSED_TAX, F.lit(-1)).otherwise(F.col("l_quantity").cast("long"))
    return lines.select(F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("line_id"), "sku_id", "region", F.col("l_shipdate").cast("date").alias("date"),
                        qty.alias("sales_qty"), F.col("l_extendedprice").cast("decimal(14,2)").alias("revenue_inr"),
                        F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("long")).otherwise(0).alias("returns_qty"))


@register
def ingested_pos(spark, root):
    """Two deliveries of till files, the second with everything of its year again: accepted lines by day, refused ones aside."""
    used = [c for c in retail.LINE_COLUMNS if c != "l_discount"]
    rows = _pos_lines(stage(retail.lines(spark, root).select("sku_id", "region", "l_partkey", *used), "pos-lines"))
    feed, target = scratch_path(spark, "pos-feed"), scratch_path(spark, "pos")
    year = F.lit(rows.agg(F.max(F.year("date"))).first()[0])
    for part in (rows.filter(F.year("date") <= year), rows.filter(F.year("date") == year)):
        # a packed file is read by one task, so files are kept small
        part.write.mode("append").option("header", True).option("compression", "gzip").option("maxRecordsPerFile", 1_000_000).csv(feed)
        ingest.ingest(spark, ingest.POS, feed, target)
    taken = ingest.read_feed(spark, ingest.POS, target).groupBy("date").agg(F.count("*").alias("lines"), F.sum("sales_qty").alias("sales_qty"), F.sum("returns_qty").alias("returns_qty"))
    refused = ingest.read_refused(spark, target).select(F.to_date(F.get_json_object("row", "$.date")).alias("date"), F.get_json_object("row", "$.line_id").alias("line_id"))
    refused = refused.distinct().groupBy("date").agg(F.count("*").alias("refused"))
    return taken.join(refused, "date", "full").select("date", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lines", "sales_qty", "returns_qty", "refused")])


@register
def ingested_competitor(spark, root):
    """Competitor prices of every order line, delivered by month in one file each; newest price of a key."""
    lines = retail.lines(spark, root)
    prices = lines.groupBy("sku_id", F.col("region").alias("competitor"), F.col("l_shipdate").cast("date").alias("date")).agg(
        (F.max(F.floor(F.col("l_extendedprice") * 100 + 0.5)) / 100).cast("decimal(10,2)").alias("price_inr"))
    feed, target = scratch_path(spark, "competitor-feed"), scratch_path(spark, "competitor")
    prices.write.json(feed)
    ingest.ingest(spark, ingest.COMPETITOR, feed, target, kind="json", max_files=4)
    stored = ingest.read_feed(spark, ingest.COMPETITOR, target)
    return rounded(stored.groupBy("competitor").agg(F.count("*").alias("prices"), F.min("price_inr").cast("double").alias("lowest"), F.max("price_inr").cast("double").alias("highest")), 2)


def _refreshed_views(spark, root) -> str:
    """Views over all but one week in sixty, then those weeks as a late load."""
    t = retail.load(spark, root)
    path = scratch_path(spark, "incremental")
    late = F.datediff(F.lit(t.as_of), "date") % 420 < 7
    for number, chosen in enumerate((~late, late)):
        incremental.record_load(t.sales.filter(chosen).select("date"), path, number)
        there = t.sales if number else t.sales.filter(chosen)

        def sources(days, there=there):
            pick = lambda df, c: df.join(days.select(F.col("date").alias(c)), c, "left_semi")
            return pick(there, "date"), pick(t.forecasts, "target_date"), pick(t.inventory, "snapshot_date")

        incremental.refresh(spark, path, sources)
    return path


@register
def views_incremental(spark, root):
    """The regional view after a late load, equal to a full rebuild."""
    return rounded(incremental.regional_view(spark, _refreshed_views(spark, root)), 8)


@register
def months_incremental(spark, root):
    """Monthly sums kept from stored regional days."""
    months = spark.read.parquet(f"{_refreshed_views(spark, root)}/regional_months")
    return rounded(months.withColumn(fx.MONTH_PARTITION, F.col(fx.MONTH_PARTITION).cast("string")), 6)


# ---- indicators ----------------------------------------------------------------------------------

def _kpis(t, days: int | None = None) -> DataFrame:
    """Daily KPIs; with ``days`` of the trailing days only, so that older months are never opened."""
    if days is None:
        return kpis.sku_daily_kpis(t.sales, t.forecasts, t.inventory)
    return kpis.sku_daily_kpis(fx.trailing(t.sales, t.as_of, days), fx.trailing(t.forecasts, t.as_of, days, "target_date"),
                               fx.trailing(t.inventory, t.as_of, days, "snapshot_date"))


@register
def sku_daily_kpis(spark, root):
    return _promo_free(_kpis(retail.load(spark, root)))


@register
def regional_daily_kpis(spark, root):
    return rounded(kpis.regional_daily_kpis(_kpis(retail.load(spark, root))), 8)


@register
def regional_kpis(spark, root):
    t = retail.load(spark, root)
    recent = fx.trailing(t.sales, t.as_of, 30)
    daily = kpis.regional_daily_kpis(kpis.sku_daily_kpis(recent, t.forecasts, t.inventory))
    start = F.date_sub(F.lit(t.as_of), 30)
    return rounded(kpis.regional_kpis(daily, start, t.as_of))


@register
def portfolio_kpis(spark, root):
    t = retail.load(spark, root)
    return rounded(kpis.portfolio_kpis(t.sales, t.forecasts, t.inventory, t.products, t.as_of), 4)


@register
def inventory_turnover(spark, root):
    t = retail.load(spark, root)
    return rounded(kpis.inventory_turnover(t.sales, t.inventory, t.products, t.as_of), 4)


@register
def demand_coverage(spark, root):
    t = retail.load(spark, root)
    return rounded(kpis.demand_coverage(t.sales, t.inventory, t.as_of))


@register
def overstock_saving(spark, root):
    t = retail.load(spark, root)
    return rounded(kpis.overstock_saving(t.sales, t.products, t.as_of), 4)


@register
def stockout_reduction(spark, root):
    t = retail.load(spark, root)
    return rounded(kpis.stockout_reduction(_kpis(t, 60), t.as_of))


@register
def wape_bias(spark, root):
    return rounded(kpis.weighted_error(_kpis(retail.load(spark, root))))


@register
def monthly_accuracy(spark, root):
    return rounded(kpis.monthly_accuracy(_kpis(retail.load(spark, root))))


@register
def regional_flags(spark, root):
    t = retail.load(spark, root)
    period = kpis.regional_kpis(kpis.regional_daily_kpis(_kpis(t, 365)), F.date_sub(F.lit(t.as_of), 365), t.as_of)
    return rounded(kpis.regional_flags(period))


@register
def return_rates(spark, root):
    return rounded(kpis.return_rates(retail.load(spark, root).sales))


# ---- monitoring and writes -----------------------------------------------------------------------

@register
def psi_drift(spark, root):
    t = retail.load(spark, root)
    return rounded(monitoring.psi(t.sales, t.as_of))


@register
def realized_mape(spark, root):
    t = retail.load(spark, root)
    filled = sinks.realize_forecasts(fx.trailing(t.forecasts, t.as_of, 1, "target_date"), fx.trailing(t.sales, t.as_of, 1), t.as_of)
    return rounded(monitoring.realized_mape(filled, F.date_sub(F.lit(t.as_of), 1)))


@register
def realize_forecasts(spark, root):
    t = retail.load(spark, root)
    out = sinks.realize_forecasts(t.forecasts, t.sales, t.as_of)
    return rounded(out.withColumn("predicted_qty", F.col("predicted_qty").cast("double")))


@register
def quality_gate(spark, root):
    t = retail.load(spark, root)
    newest = t.model_versions.filter("stage = 'Staging'").groupBy("model_name").agg(
        F.max_by("avg_mape", "version").alias("avg_mape"))
    return rounded(monitoring.quality_gate(newest, threshold=25.0))


@register
def latest_model_versions(spark, root):
    return rounded(monitoring.promote_versions(retail.load(spark, root).model_versions))


@register
def model_forecast_errors(spark, root):
    t = retail.load(spark, root)
    actual = t.sales.select("sku_id", "region", F.col("date").alias("target_date"), F.col("sales_qty").alias("actual"))
    scored = t.forecasts.withColumnRenamed("predicted_qty", "predicted").join(actual, ["sku_id", "region", "target_date"])
    return rounded(kpis.forecast_errors(scored, ["model_name", "model_version"]))


@register
def dedupe_latest(spark, root):
    lines = spark.read.parquet(f"{root}/lineitem.parquet")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    kept = sinks.dedupe_latest(lines.withColumn("l_tax", F.col("l_tax") + 0.0), ["l_orderkey", "l_linenumber"], order)
    return kept.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@register
def weather_append_absent(spark, root):
    t = retail.load(spark, root)
    scores = t.weather.withColumn("score", F.col("score").cast("double"))
    target = scores.filter(F.col("date") <= F.date_sub(F.lit(t.as_of), 365))
    fresh = scores.withColumn("score", F.col("score") + 100)
    return rounded(sinks.upsert_absent(fresh, target, ["region", "date"]))


@register
def inventory_two_days(spark, root):
    """A backfill, the next day's load and its replay; every day is there once."""
    t = retail.load(spark, root)
    path = scratch_path(spark, "inventory_store")
    sinks.sync_inventory(t.inventory.filter(F.col("snapshot_date") < F.lit(t.as_of)), path)
    for _ in range(2):
        jobs.ingest_inventory(t.inventory, t.as_of, path)
    return spark.read.parquet(path).select("sku_id", "warehouse_id", "snapshot_date", "quantity_on_hand")


@register
def features_two_runs(spark, root):
    """Two runs of the feature job five days apart; days of the first that the second does not cover stay."""
    t = retail.load(spark, root)
    path = scratch_path(spark, "feature_store")
    for back in (5, 0):
        jobs.run_features(t, t.as_of - dt.timedelta(days=back), path)
    lags = [F.col(c).cast("long").alias(c) for c in ("lag_7", "lag_28")]
    return spark.read.parquet(path).select("sku_id", "region", "date", "sales_qty", *lags, "is_promotion")


@register
def views_after_refresh(spark, root):
    """A refresh after the older months have left the source."""
    t = retail.load(spark, root)
    path, daily = scratch_path(spark, "views"), _kpis(t)
    sinks.refresh_views(daily, kpis.regional_daily_kpis, path)
    sinks.refresh_views(daily.filter(F.col("date") > F.date_sub(F.lit(t.as_of), 200)), kpis.regional_daily_kpis, path)
    return rounded(spark.read.parquet(f"{path}/regional_kpis").drop(fx.MONTH_PARTITION), 8)


@register
def weather_scores(spark, root):
    """Temperatures to scores and cities, over every weather row; the given regions stand for the mapped ones."""
    t = retail.load(spark, root)
    kelvin = F.col("score").cast("double") * 10 + 290
    given = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    city = fx.region_city(fx.lookup("region", dict(zip(given, fx.REGION_CITY))))
    return t.weather.select("region", "date", (fx.weather_score(kelvin) + 0.0).alias("score"), city.alias("city"))


@register
def dq_unique(spark, root):
    t = retail.load(spark, root)
    return quality.duplicate_keys(t.competitor, ["sku_id", "date"])


@register
def dq_not_null(spark, root):
    t = retail.load(spark, root)
    return quality.null_counts(t.forecasts, ["sku_id", "region", "target_date", "predicted_qty", "realized_mape"])


@register
def dq_referential(spark, root):
    t = retail.load(spark, root)
    discontinued = t.products.filter("is_active")
    return quality.orphans(t.sales, discontinued, "sku_id", "sku_id").groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("orphan_rows"), F.sum("sales_qty").alias("orphan_qty"))


@register
def dq_domain(spark, root):
    t = retail.load(spark, root)
    rule = F.col("sales_qty").between(1, 60) & quality.max_length("region", 10)
    return quality.domain_violations(t.sales, rule).select("sku_id", "region", "date", "sales_qty")


@register
def dq_report(spark, root):
    t = retail.load(spark, root)
    return quality.report({
        "sales key": quality.duplicate_keys(t.sales, ["sku_id", "region", "date"]),
        "competitor key": quality.duplicate_keys(t.competitor, ["sku_id", "date"]),
        "inventory key": quality.duplicate_keys(t.inventory, ["sku_id", "warehouse_id", "snapshot_date"]),
        "sales product": quality.orphans(t.sales, t.products, "sku_id", "sku_id"),
        "stock not negative": quality.domain_violations(t.inventory, F.col("quantity_on_hand") >= 0),
    })


@register
def kaplan_meier(spark, root):
    t = retail.load(spark, root)
    return rounded(monitoring.kaplan_meier(monitoring.stock_spells(restock.inventory_by_region(t.inventory)), "region"))


# ---- promotions ----------------------------------------------------------------------------------

PROMOTED = ["Brand#1", "Brand#2", "Brand#6"]
PROMO_START, PROMO_END = "2000-03-01", "2000-04-30"


@register
def promo_expand(spark, root):
    t = retail.load(spark, root)
    return promotions.expand_promotions(t.sales, t.promotions, 7, 7).select(
        "promo_id", "phase", "sku_id", "region", "date", "sales_qty", "discount_pct")


@register
def promo_tagged_sales(spark, root):
    t = retail.load(spark, root)
    return promotions.tag_promotions(t.sales, t.promotions).select("sku_id", "region", "date", "sales_qty", "promo_id", "is_promotion")


@register
def promo_lift(spark, root):
    t = retail.load(spark, root)
    return rounded(promotions.promo_lift(t.sales, t.promotions))


@register
def promo_decay(spark, root):
    t = retail.load(spark, root)
    return rounded(promotions.promo_decay(t.sales, t.promotions))


@register
def uplift_pct(spark, root):
    """Uplift of promotion rows over the others per SKU, with its report band."""
    t = retail.load(spark, root)
    means = t.sales.groupBy("sku_id").agg(
        F.avg(F.when(F.col("is_promotion"), F.col("sales_qty"))).alias("during"),
        F.avg(F.when(~F.col("is_promotion"), F.col("sales_qty"))).alias("baseline"))
    out = means.withColumn("uplift_pct", kpis.uplift_pct("during", "baseline"))
    return rounded(out.withColumn("band", labels.lift_band(fx.ratio("during", "baseline"))))


@register
def did_lift(spark, root):
    t = retail.load(spark, root)
    out = promotions.did_lift(t.sales, PROMOTED, PROMO_START, PROMO_END)
    return rounded(out.drop("price_elasticity"), 4)


@register
def price_elasticity(spark, root):
    t = retail.load(spark, root)
    out = promotions.did_lift(t.sales, PROMOTED, PROMO_START, PROMO_END, "bogo", 20.0, regions=["ASIA", "EUROPE"])
    return rounded(out.select("promotion_type", "did", "price_elasticity"))


@register
def cannibalization(spark, root):
    t = retail.load(spark, root)
    return rounded(promotions.cannibalization(t.sales, t.products, PROMOTED, PROMO_START, PROMO_END))


# ---- search --------------------------------------------------------------------------------------

@register
def fuzzy_product_search(spark, root):
    t = retail.load(spark, root, grain="part")
    return rounded(search.fuzzy_product_search(t.products, "blu widgets", 50))


@register
def similar_product_names(spark, root):
    t = retail.load(spark, root, grain="part")
    return rounded(search.similar_names(t.products))


@register
def product_similarity(spark, root):
    """Similarity of every product name to the query, unranked."""
    t = retail.load(spark, root, grain="part")
    score = search.similarity(search.trigrams("product_name"), search.trigrams(F.lit("smal rings")))
    return rounded(t.products.select("sku_id", "product_name", score.alias("similarity")))


# ---- forecasting ---------------------------------------------------------------------------------

HORIZON = 28


@register
def seasonal_strength(spark, root):
    return rounded(forecasting.seasonal_strength(retail.load(spark, root).sales))


@register
def seasonal_forecast(spark, root):
    t = retail.load(spark, root)
    return rounded(forecasting.seasonal_forecast(forecasting.seasonal_params(t.sales), HORIZON))


@register
def lookback_forecast(spark, root):
    t = retail.load(spark, root)
    return rounded(forecasting.lookback_forecast(forecasting.lookback_params(t.sales), HORIZON))


@register
def seasonal_naive(spark, root):
    return rounded(forecasting.seasonal_naive(retail.load(spark, root).sales, 365))


@register
def ensemble_forecast(spark, root):
    t = retail.load(spark, root)
    members = forecasting.closed_form_members(t.sales, HORIZON)
    return forecasting.ensemble(members, {"seasonal": 0.4, "naive": 0.4, "lookback": 0.2})


@register
def backtest_naive(spark, root):
    t = retail.load(spark, root)
    return rounded(forecasting.backtest(t.sales, t.as_of, folds=6, horizon=HORIZON, model="naive"))


@register
def backtest_seasonal(spark, root):
    t = retail.load(spark, root)
    return rounded(forecasting.backtest(t.sales, t.as_of, folds=3, horizon=HORIZON, model="seasonal"), 4)


@register
def backtest_lookback(spark, root):
    t = retail.load(spark, root)
    return rounded(forecasting.backtest(t.sales, t.as_of, folds=3, horizon=HORIZON, model="lookback"), 4)


@register
def tune_weights(spark, root):
    t = retail.load(spark, root)
    scored = forecasting.holdout_members(t.sales, t.as_of, 90).join(t.products.select("sku_id", "category"), "sku_id")
    return rounded(forecasting.tune_weights(scored), 4)


@register
def fitted_weights(spark, root):
    """Weights of the closed-form members with the lowest squared error of each category, on the last 90 days."""
    t = retail.load(spark, root)
    scored = forecasting.holdout_members(t.sales, t.as_of, 90).join(t.products.select("sku_id", "category"), "sku_id")
    return rounded(simplex.fit_weights(scored), 6)


@register
def gbt_forecast(spark, root):
    t = retail.load(spark, root)
    model = boosting.fit_gbt(t.sales, t.as_of, HORIZON)
    return boosting.gbt_forecast(model, t.sales, HORIZON)


@register
def conformal_widths(spark, root):
    """Calibrated half-widths of the closed-form members by week ahead, from the last 90 days."""
    t = retail.load(spark, root)
    cutoff = t.as_of - dt.timedelta(days=90)
    held = stage(forecast_jobs.holdout(t.sales, t.as_of, 90, boosted=False), "conformal-holdout")
    levels = conformal.series_level(t.sales.filter(F.col("date") <= F.lit(cutoff)))
    return rounded(conformal.calibrate(held, levels, cutoff, ["seasonal", "lookback"]))


@register
def backtest_members(spark, root):
    """Walk-forward errors of the closed-form members and of their ensemble."""
    t = retail.load(spark, root)
    return rounded(forecast_jobs.backtest(t.sales, t.as_of, 3, HORIZON, boosted=False), 4)


@register
def backtest_boosted(spark, root):
    """The newest fold with the boosted member, full settings, and the ensemble of all three."""
    t = retail.load(spark, root)
    return rounded(forecast_jobs.backtest(t.sales, t.as_of, 1, HORIZON), 4)


@register
def trained_model_errors(spark, root):
    """The training job of each closed-form model: errors on its last 28 days."""
    t = retail.load(spark, root)
    errors = [jobs.train_all(t, m) for m in ("seasonal", "lookback", "naive")]
    return rounded(errors[0].unionByName(errors[1]).unionByName(errors[2]), 4)


@register
def served_forecast(spark, root):
    """Two published versions; the one that had seen nothing of the last four weeks is asked for and served from its tables."""
    t = retail.load(spark, root)
    store = ModelStore(spark, scratch_path(spark, "models"))
    for back in (HORIZON, 0):
        upto = t.as_of - dt.timedelta(days=back)
        forecast_jobs.train(t.sales.filter(F.col("date") <= F.lit(upto)), upto, store, holdout_days=HORIZON, boosted=False)
    served = api.serve_forecast(store, horizon_days=HORIZON, include_ci=False, as_of=t.as_of - dt.timedelta(days=1))
    return served.drop("lower_bound", "upper_bound")


# ---- clusters and anomalies ----------------------------------------------------------------------

def _matrix(t, **options) -> DataFrame:
    return clustering.sku_feature_matrix(t.sales, t.products, kpis.return_rates(t.sales),
                                         promotions.promo_lift(t.sales, t.promotions), t.as_of, **options)


def _rounded_matrix(matrix: DataFrame) -> DataFrame:
    """Ratios of counts can end in a 5 at the seventh decimal, so they keep eight."""
    return rounded(rounded(matrix, 6, "gross_margin", "avg_order_value"), 8)


@register
def sku_feature_matrix(spark, root):
    return _rounded_matrix(_matrix(retail.load(spark, root)))


@register
def sku_feature_matrix_part(spark, root):
    """Feature matrix at product grain: as many SKUs as there are parts."""
    t = retail.load(spark, root, grain="part")
    return _rounded_matrix(_matrix(t, days=_history_days(t), min_rows=10))


@register
def peak_month(spark, root):
    t = retail.load(spark, root)
    return clustering.peak_month(t.sales, t.as_of)


@register
def cluster_labels(spark, root):
    """Labels and report rows for a fixed assignment of SKUs to six groups."""
    fixed = _matrix(retail.load(spark, root)).withColumn("cluster", (retail.sku_number() % 6).cast("int"))
    return clustering.describe_clusters(fixed)


@register
def cluster_distribution(spark, root):
    fixed = _matrix(retail.load(spark, root)).withColumn("cluster", (retail.sku_number() % 6).cast("int"))
    return kpis.cluster_distribution(clustering.describe_clusters(fixed))


@register
def sku_clusters(spark, root):
    return clustering.sku_clusters(_matrix(retail.load(spark, root)), 4)


@register
def sku_clusters_part(spark, root):
    t = retail.load(spark, root, grain="part")
    matrix = _matrix(t, days=_history_days(t), min_rows=10)
    return clustering.sku_clusters(matrix, 4, ["velocity", "margin", "volume", "seasonality"])


@register
def match_controls(spark, root):
    t = retail.load(spark, root, grain="part")
    clustered = clustering.cluster_skus(_matrix(t, days=_history_days(t), min_rows=10), 4)
    promoted = t.sales.groupBy("sku_id").agg(F.avg(F.col("is_promotion").cast("double")).alias("share")).filter("share > 0.25")
    return causal.match_controls(stage(clustered, "clustered"), promoted)


@register
def anomaly_causes(spark, root):
    """Scaling, direction, cause and ranking on a given raw score (distance from the rolling mean)."""
    t = retail.load(spark, root)
    rows = anomaly.detection_rows(t.sales, t.weather, t.competitor, t.inventory, t.as_of, 180)
    raw = -F.abs(F.col("daily_sales") - F.col("rolling_mean_7")) / (F.col("rolling_std_7") + 1)
    return anomaly.score_events(rows.withColumn("raw_score", F.round(raw, 6)), t.as_of, 180)


@register
def detect_anomalies(spark, root):
    t = retail.load(spark, root)
    return anomaly.detect_anomalies(t.sales, t.weather, t.competitor, t.inventory, t.as_of, days_back=180)


@register
def attribute_spikes(spark, root):
    t = retail.load(spark, root)
    full = features.build_features(t.sales, t.weather, t.competitor, t.as_of, lookback=_history_days(t))
    keys = ["sku_id", "region", "date"]
    return causal.attribute_spikes(full, features.two_sigma_flags(t.sales).filter("outside"), keys)


@register
def attribute_spikes_boosted(spark, root):
    """Every spike explained by the trees of a boosted demand model, over the whole history."""
    t = retail.load(spark, root)
    full = features.build_features(t.sales, t.weather, t.competitor, t.as_of, lookback=_history_days(t))
    return causal.attribute_spikes_boosted(full, features.two_sigma_flags(t.sales).filter("outside"), ["sku_id", "region", "date"])


# ---- streams -------------------------------------------------------------------------------------

def _sales_stream(spark, root):
    """The purchases of the click stream, and what closes it once it is read."""
    folder = scratch_path(spark, "closing")
    clicks = events.with_closing(events.read_clicks(spark, f"{root}/events*.parquet"), folder)
    stream = events.deduplicated(events.sales_from_clicks(clicks, retail.region_names(spark, root)))
    return stream, lambda: events.close_clicks(spark.read.parquet(f"{root}/events.parquet").filter("event_type = 'purchase'"), folder)


def _sales_batch(spark, root) -> DataFrame:
    return events.sales_from_clicks(spark.read.parquet(f"{root}/events.parquet"), retail.region_names(spark, root))


@register
def stream_daily_sales(spark, root):
    retail.load(spark, root)
    stream, close = _sales_stream(spark, root)
    return rounded(drain(aggregates.flat_days(aggregates.daily_sales(stream)), "daily", close), 4)


@register
def stream_rolling_stats(spark, root):
    retail.load(spark, root)
    stream, close = _sales_stream(spark, root)
    return rounded(drain(aggregates.rolling_stats(aggregates.daily_sales(stream)), "rolling", close))


@register
def stream_enriched_sales(spark, root):
    t = retail.load(spark, root)
    stream, close = _sales_stream(spark, root)
    products = stage(t.products, "stream_products")  # read by every micro-batch, computed once
    days = aggregates.flat_days(aggregates.daily_sales(stream))
    return rounded(drain(aggregates.enriched(days, products).drop("revenue", "events"), "enriched", close), 4)


@register
def stream_alerts(spark, root):
    """The last seven days of the stream against the days before them."""
    retail.load(spark, root)
    known = aggregates.flat_days(aggregates.daily_sales(_sales_batch(spark, root)))
    start = F.lit(known.agg(F.date_sub(F.max("date"), 6)).first()[0])
    history = stage(aggregates.baseline(known.filter(F.col("date") < start)), "alert_baseline")
    stream, close = _sales_stream(spark, root)
    days = aggregates.flat_days(aggregates.daily_sales(stream)).filter(F.col("date") >= start)
    return rounded(drain(aggregates.alerts(days, history), "alerts", close))


@register
def stream_state_alerts(spark, root):
    """Every finished day against the days of its series before it, from state that the stream keeps."""
    retail.load(spark, root)
    stream, close = _sales_stream(spark, root)
    return rounded(drain(stateful.stateful_alerts(stream, least_days=3), "state-alerts", close))


@register
def stream_forecast_monitoring(spark, root):
    t = retail.load(spark, root)
    error = fx.abs_pct_error("sales_qty", "predicted_qty")
    actual = t.sales.select("sku_id", "region", F.col("date").alias("target_date"), "sales_qty")
    payload = t.forecasts.join(actual, ["sku_id", "region", "target_date"]).select(
        "sku_id", "region", F.col("model_name").alias("model"), F.datediff("target_date", "forecast_date").alias("horizon_days"),
        error.alias("mape"), F.col("target_date").cast("timestamp").alias("ts"))
    topic = scratch_path(spark, "forecast_events")
    payload.select(fx.to_event_json(*payload.columns).alias("value")).write.text(topic)
    good, _ = events.parse_events(events.read_topic(spark, "forecast-events", {"format": "text", "path": topic}), "forecast-events")

    def close():
        end = payload.agg(F.max("ts").alias("ts")).select(
            F.lit("").alias("sku_id"), F.lit("").alias("region"), F.lit("closing").alias("model"), F.lit(0).alias("horizon_days"),
            F.lit(0.0).alias("mape"), F.expr("ts + INTERVAL '30' DAY").alias("ts"))
        end.select(fx.to_event_json(*payload.columns).alias("value")).write.mode("append").text(topic)

    return rounded(drain(aggregates.forecast_monitoring(good), "monitoring", close))


@register
def stream_current_stock(spark, root):
    t = retail.load(spark, root)
    updates = t.inventory.select("sku_id", "warehouse_id", "region", "quantity_on_hand",
                                 F.col("snapshot_date").cast("timestamp").alias("ts"))
    feed, log = scratch_path(spark, "inventory_updates"), scratch_path(spark, "stock_log")
    updates.write.parquet(feed)
    source = spark.readStream.schema(updates.schema).option("maxFilesPerTrigger", 100).parquet(feed)
    stock_log(source, f"{log}/data", f"{log}/checkpoint").awaitTermination()
    return current_stock(spark, f"{log}/data").withColumn("ts", F.col("ts").cast("date"))


@register
def event_json(spark, root):
    """Sales events encoded to JSON payloads and decoded again."""
    retail.load(spark, root)
    sales = _sales_batch(spark, root)
    raw = sales.select(fx.to_event_json(*sales.columns).alias("value"))
    good, _ = events.parse_events(raw, "sales-events")
    return good.select("event_id", "sku_id", "region", "qty", "amount", F.unix_micros("ts").alias("ts_micros"))


@register
def forecast_ensemble(spark, root):
    """Seasonal, boosted and lookback members combined, every series."""
    t = retail.load(spark, root)
    return api.forecast(t, horizon_days=HORIZON, days_back=_history_days(t))
