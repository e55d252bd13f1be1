"""Matched controls by propensity score, and spike attribution by a linear model."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import attach_row, scratch_path, stage
from . import tree_shap
from .clustering import MATRIX_COLUMNS, standardize

DRIVERS = ["is_promotion", "rolling_mean_28", "competitor_price_delta", "weather_score"]


def nearest_match(left: DataFrame, right: DataFrame, by: str, score: str, right_id: str, buckets: int = 1000) -> DataFrame:
    """For each left row the right row of the same ``by`` group with the nearest score (ties: the lower).

    A left row whose group has no right row is left out.

    No pairs are formed. Both sides are reduced to distinct scores (many equal scores become one row),
    cut into quantile buckets, and matched by a running last/next value inside a bucket; a table with
    one row per bucket carries the nearest score across empty or boundary buckets. Exact for any
    distribution of the scores.
    """
    rights = right.groupBy(by, score).agg(F.min(right_id).alias("_id"))
    lefts = left.select(by, score).distinct()
    points = lefts.withColumn("_r", F.lit(None).cast(rights.select(F.struct(score, "_id").alias("x")).schema["x"].dataType)).unionByName(
        rights.select(by, score, F.struct(score, "_id").alias("_r")))
    cuts = sorted(set(rights.approxQuantile(score, [i / buckets for i in range(1, buckets)], 0.25 / buckets)))
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        points = Bucketizer(splits=splits, inputCol=score, outputCol="_bucket").transform(points)
    else:
        points = points.withColumn("_bucket", F.lit(0.0))
    here = Window.partitionBy(by, "_bucket")
    up = here.orderBy(F.col(score)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = here.orderBy(F.col(score).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = points.withColumns({"_lo": F.last("_r", ignorenulls=True).over(up), "_hi": F.last("_r", ignorenulls=True).over(down)})
    edges = points.groupBy(by, "_bucket").agg(F.max("_r").alias("_top"), F.min("_r").alias("_bottom"))
    along = Window.partitionBy(by).orderBy("_bucket")
    edges = edges.select(
        by, "_bucket",
        F.last("_top", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_bottom", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    lo, hi = F.coalesce("_lo", "_before"), F.coalesce("_hi", "_after")
    gap_lo, gap_hi = F.col(score) - lo[score], hi[score] - F.col(score)
    best = F.when(lo.isNull(), hi).when(hi.isNull() | (gap_lo <= gap_hi), lo).otherwise(hi)
    table = (
        inside.filter(F.col("_r").isNull()).join(edges, [by, "_bucket"]).withColumn("_best", best)
        .filter(F.col("_best").isNotNull())
        .select(by, score, F.col("_best._id").alias(f"matched_{right_id}"), F.col(f"_best.{score}").alias("matched_score"))
    )
    return left.join(table, [by, score])


def propensity(matrix: DataFrame, treated: DataFrame, columns=MATRIX_COLUMNS) -> DataFrame:
    """Probability of being promoted given the SKU features; ``treated`` lists the promoted sku_id.

    A model fresh from its fit holds the session through its training summary, and a session that has observed any
    query cannot be sent to tasks; the model as stored has no summary.
    """
    flags = treated.select("sku_id").distinct().withColumn("treated", F.lit(1.0))
    rows = matrix.join(flags, "sku_id", "left").na.fill({"treated": 0.0})
    scaled, _ = standardize(rows, columns)
    model = LogisticRegression(featuresCol="scaled", labelCol="treated", regParam=0.01).fit(scaled)
    path = scratch_path(matrix.sparkSession, "propensity-model")
    model.write().save(path)
    model = LogisticRegressionModel.load(path)
    chance = vector_to_array("probability")[1]
    return model.transform(scaled).select(*matrix.columns, "treated", chance.alias("propensity"))


def match_controls(clustered: DataFrame, treated: DataFrame, columns=MATRIX_COLUMNS) -> DataFrame:
    """One control per treated SKU: same cluster, nearest propensity; a control may serve several, null if there is none."""
    scored = stage(propensity(clustered.drop("features"), treated, columns), "propensity")
    promoted = scored.filter("treated = 1").select("sku_id", "cluster", "propensity")
    control = scored.filter("treated = 0").select(F.col("sku_id").alias("control_id"), "cluster", "propensity")
    matched = nearest_match(promoted, control, "cluster", "propensity", "control_id")
    matched = matched.select("sku_id", F.col("matched_control_id").alias("control_sku_id"), F.col("matched_score").alias("control_propensity"))
    return promoted.join(matched, "sku_id", "left")


def attribute_spikes(features: DataFrame, spikes: DataFrame, on) -> DataFrame:
    """Contribution of promotion, recent level, competitor and weather to each spike, in units.

    All spikes are returned; the effects are null where the features of the day are not complete. Coefficient times distance from the mean: exact Shapley values of a linear model with independent inputs.
    """
    typed = {c: F.col(c).cast("double") for c in DRIVERS} | {"label": F.col("sales_qty").cast("double")}
    kept = features.select(*on, "sales_qty", *DRIVERS).na.drop(subset=["rolling_mean_28"])
    rows = stage(kept.withColumns(typed), "drivers")
    vectors = VectorAssembler(inputCols=DRIVERS, outputCol="x").transform(rows)
    model = LinearRegression(featuresCol="x", labelCol="label", regParam=1e-6).fit(vectors)
    weights = [float(w) for w in model.coefficients]
    means = rows.agg(*[F.avg(c).alias(f"_m_{c}") for c in DRIVERS], F.avg("label").alias("average_sales"))
    names = dict(zip(DRIVERS, ["promotion", "level", "competitor", "weather"]))
    return attach_row(spikes.select(*on, "sales_qty").join(rows.drop("sales_qty"), on, "left"), means).select(
        *on, "sales_qty", "average_sales",
        *[(F.lit(w) * (F.col(c) - F.col(f"_m_{c}"))).alias(f"{names[c]}_effect") for c, w in zip(DRIVERS, weights)])


#: Inputs of the boosted demand model, by the driver they belong to.
BOOSTED_DRIVERS = {"is_promotion": "promotion", "rolling_mean_7": "level", "rolling_mean_28": "level", "lag_7": "level", "competitor_price_delta": "competitor",
                   "weather_score": "weather", "day_of_week": "season", "month": "season", "is_holiday": "season"}


def attribute_spikes_boosted(features: DataFrame, spikes: DataFrame, on, **gbt_params) -> DataFrame:
    """Contribution of promotion, season, recent level, competitor and weather to each spike in a boosted demand model.

    Exact path-dependent Shapley values of the fitted trees: base and effects sum to the model's prediction. All
    spikes are returned; effects are null where the features of the day are not complete.
    """
    inputs = list(BOOSTED_DRIVERS)
    typed = {c: F.col(c).cast("double") for c in inputs} | {"label": F.col("sales_qty").cast("double")}
    rows = stage(features.select(*on, "sales_qty", *inputs).na.drop(subset=inputs).withColumns(typed), "boosted-drivers")
    vectors = VectorAssembler(inputCols=inputs, outputCol="x").transform(rows)
    params = {**dict(maxIter=60, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, minInstancesPerNode=5, seed=42), **gbt_params}
    model = GBTRegressor(featuresCol="x", labelCol="label", **params).fit(vectors)
    asked = rows.drop("sales_qty", "label").join(spikes.select(*on), on, "left_semi")
    explained = tree_shap.attribute(asked, model, inputs)
    of = lambda group: reduce(add, [F.col(f"{c}_effect") for c, g in BOOSTED_DRIVERS.items() if g == group])
    groups = list(dict.fromkeys(BOOSTED_DRIVERS.values()))
    effects = explained.select(*on, "base", *[of(g).alias(f"{g}_effect") for g in groups])
    total = reduce(add, [F.col(f"{g}_effect") for g in groups], F.col("base"))
    return spikes.select(*on, "sales_qty").join(effects.withColumn("predicted", total), on, "left")
