"""Boosted-tree forecast: one global model over all series, trained directly for several horizons."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..schemas import SERIES_KEYS
from ..session import stage
from .features import series_window

#: Learner settings. Spark has no L2 leaf penalty; small leaves are barred instead.
GBT_PARAMS = dict(maxIter=400, stepSize=0.05, maxDepth=6, subsamplingRate=0.8, featureSubsetStrategy="0.8",
                  minInstancesPerNode=5, validationTol=0.001, seed=42, maxBins=64)
TRAIN_DAYS = 548
HORIZONS = (1, 7, 14, 28, 60, 90, 180, 365)
ORIGIN_FEATURES = ["lag_0", "lag_7", "lag_14", "lag_21", "lag_28", "mean_7", "mean_28", "std_7", "series_mean"]
INPUTS = ORIGIN_FEATURES + ["dow", "month", "holiday", "horizon"]


def origin_features(sales: DataFrame, keys=SERIES_KEYS) -> DataFrame:
    """What is known at the end of each day: current and earlier rows only."""
    w = series_window(keys)
    y = F.col("sales_qty").cast("double")
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    return sales.select(
        *keys, F.col("date").alias("origin"), y.alias("lag_0"),
        *[F.coalesce(F.lag(y, n).over(w), y).alias(f"lag_{n}") for n in (7, 14, 21, 28)],
        F.avg(y).over(w.rowsBetween(-6, 0)).alias("mean_7"), F.avg(y).over(w.rowsBetween(-27, 0)).alias("mean_28"),
        F.coalesce(F.stddev_samp(y).over(w.rowsBetween(-6, 0)), F.lit(0.0)).alias("std_7"),
        F.avg(y).over(past).alias("series_mean"))


def _target_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "date": F.expr("date_add(origin, horizon)"),
    }).withColumns({"dow": fx.day_of_week("date"), "month": F.month("date"), "holiday": fx.is_holiday("date").cast("double")})


def training_rows(sales: DataFrame, as_of, horizon: int, keys=SERIES_KEYS, train_days: int = TRAIN_DAYS, origin_every: int = 1,
                  horizons=HORIZONS) -> DataFrame:
    """(series, origin, horizon) rows with the sales of the target day.

    Every day of the last ``train_days`` is an origin, or every ``origin_every``-th one counted back from
    ``as_of``; the window features are computed before. The learner is trained on those ``horizons``
    below the one asked for, and on it. Targets lie after their origin, features do not.
    """
    grid = sorted({h for h in horizons if h < horizon} | {horizon})
    spaced = F.pmod(F.datediff(F.lit(as_of).cast("date"), "origin"), F.lit(origin_every)) == 0
    origins = origin_features(sales, keys).filter(spaced & (F.col("origin") >= F.date_sub(F.lit(as_of), train_days)))
    rows = _target_features(origins.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in grid]))))
    labels = sales.select(*keys, "date", F.col("sales_qty").cast("double").alias("label"))
    recent = F.col("date") > F.date_sub(F.lit(as_of), max(28, train_days // 10))
    return rows.join(labels, [*keys, "date"]).withColumn("is_validation", recent)


def fit_gbt(sales: DataFrame, as_of, horizon: int, keys=SERIES_KEYS, train_days: int = TRAIN_DAYS,
            origin_every: int = 1, **params) -> PipelineModel:
    """Fit on the trailing history; stops early on the newest targets.

    The training rows are written once: the learner reads them for training, validation and binning.
    """
    rows = stage(training_rows(sales, as_of, horizon, keys, train_days, origin_every), "gbt_rows")
    if rows.filter("NOT is_validation").isEmpty():
        raise ValueError("no (origin, target) pair in the training window")
    gbt = GBTRegressor(featuresCol="features", labelCol="label", predictionCol="prediction",
                       validationIndicatorCol="is_validation", **{**GBT_PARAMS, **params})
    return Pipeline(stages=[VectorAssembler(inputCols=INPUTS, outputCol="features"), gbt]).fit(rows)


def newest_origins(sales: DataFrame, keys=SERIES_KEYS) -> DataFrame:
    """Origin features of each series' newest row: all that serving a fitted model needs of the history.

    ``sales`` must be the whole history of a series, as in the fit: its features look back over all of it.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc("origin"))
    return origin_features(sales, keys).withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")


def serve_gbt(model: PipelineModel, origins: DataFrame, horizon: int, keys=SERIES_KEYS) -> DataFrame:
    """Every day up to ``horizon`` after each origin, floored at zero."""
    days = _target_features(origins.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon)))))
    return model.transform(days).select(*keys, "date", fx.floor_zero("prediction").alias("boosted"))


def gbt_forecast(model: PipelineModel, sales: DataFrame, horizon: int, keys=SERIES_KEYS) -> DataFrame:
    """Every future day of every series from its newest row."""
    return serve_gbt(model, newest_origins(sales, keys), horizon, keys)
