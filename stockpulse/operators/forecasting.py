"""Closed-form forecast members, their ensemble, tuning and walk-forward evaluation.

Every series is fitted in the same plan: parameters are a table with one row per series, and all
windows share the series partitioning, so fitting costs one exchange.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..schemas import SERIES_KEYS
from .features import days_ago, row_index
from .kpis import forecast_errors

#: Fixed value: normal quantile of a two-sided 90 % interval.
Z90 = 1.645
LOOKBACK_ROWS = 60
#: Ours: weights halve every 14 rows.
LOOKBACK_DECAY = math.log(2) / 14
DEFAULT_WEIGHTS = {"seasonal": 0.4, "boosted": 0.4, "lookback": 0.2}
YEAR_OF_WEEKS = 364


def _div(a, b) -> Column:
    return fx.ratio(a, b)


def _over(keys, *more):
    return Window.partitionBy(*keys, *more)


def _index(value: Column, keys, part: Column) -> Column:
    """Mean of ``value`` in the part of the season over its mean in the series, 1 where undefined."""
    return F.coalesce(_div(F.avg(value).over(_over(keys, part)), F.avg(value).over(_over(keys))), F.lit(1.0))


def _effect(value: Column, flag: Column, keys) -> Column:
    """Mean of ``value`` on flagged rows over its mean on the others, 1 where undefined."""
    w = _over(keys)
    return F.coalesce(_div(F.avg(F.when(flag, value)).over(w), F.avg(F.when(~flag, value)).over(w)), F.lit(1.0))


def trend_at(t: Column) -> Column:
    """Fitted line at a day number, never below a tenth of the series mean."""
    return F.greatest(F.col("ybar") + F.col("slope") * (t - F.col("tbar")), F.col("ybar") * 0.1)


def seasonal_params(sales: DataFrame, keys=SERIES_KEYS) -> DataFrame:
    """Trend x weekday x month x holiday x promotion factors, one row per series.

    Each factor is fitted on what the earlier ones leave unexplained. The trend is a least-squares line
    over the day number.
    """
    w = _over(keys)
    y = F.col("sales_qty").cast("double")
    holiday, promo = F.coalesce("is_holiday", F.lit(False)), F.coalesce("is_promotion", F.lit(False))

    def typical(ratio: str, part: str) -> Column:
        """Mean ratio in one part of the season, 1 where undefined."""
        return F.coalesce(F.avg(ratio).over(_over(keys, part)), F.lit(1.0))

    fitted_rows = (
        sales.select(*keys, "date", y.alias("y"), holiday.alias("hol"), promo.alias("promo"), F.unix_date("date").cast("double").alias("t"),
                     fx.day_of_week("date").alias("dow"), F.month("date").alias("mon"))
        .withColumns({"last_date": F.max("date").over(w), "ybar": F.avg("y").over(w), "tbar": F.avg("t").over(w),
                      "slope": F.coalesce(F.regr_slope("y", "t").over(w), F.lit(0.0))})
        .withColumn("trend", trend_at(F.col("t"))).withColumn("r1", _div("y", "trend"))
        .withColumn("weekly", typical("r1", "dow")).withColumn("r2", _div("r1", "weekly"))
        .withColumn("yearly", typical("r2", "mon")).withColumn("r3", _div("r2", "yearly"))
        .withColumn("holiday_effect", _effect(F.col("r3"), F.col("hol"), keys))
        .withColumn("r4", F.when(F.col("hol"), _div("r3", "holiday_effect")).otherwise(F.col("r3")))
        .withColumn("promo_effect", _effect(F.col("r4"), F.col("promo"), keys))
        .withColumn("fitted", F.col("trend") * F.col("weekly") * F.col("yearly")
                    * F.when(F.col("hol"), F.col("holiday_effect")).otherwise(1.0)
                    * F.when(F.col("promo"), F.col("promo_effect")).otherwise(1.0))
    )

    def factors(column: str, part: str, values) -> Column:
        return F.array(*[F.coalesce(F.max(F.when(F.col(part) == v, F.col(column))), F.lit(1.0)) for v in values])

    single = ["last_date", "ybar", "tbar", "slope", "holiday_effect", "promo_effect"]
    return fitted_rows.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in single],
        factors("weekly", "dow", range(7)).alias("weekly"), factors("yearly", "mon", range(1, 13)).alias("yearly"),
        F.coalesce(F.stddev_samp(F.col("y") - F.col("fitted")), F.lit(0.0)).alias("resid_std"),
        F.count(F.lit(1)).alias("history_rows"))


def future_rows(params: DataFrame, horizon: int) -> DataFrame:
    """One row per series and future day."""
    return params.withColumn("date", F.explode(fx.future_dates("last_date", horizon)))


def seasonal_forecast(params: DataFrame, horizon: int, keys=SERIES_KEYS, planned_promos: DataFrame | None = None) -> DataFrame:
    """Member forecast with a 90 % interval. ``planned_promos`` marks (series, date) rows on promotion."""
    trend = trend_at(F.unix_date("date"))
    weekly = F.element_at("weekly", fx.day_of_week("date") + 1)
    yearly = F.element_at("yearly", F.month("date"))
    days = future_rows(params, horizon)
    promo = F.lit(1.0)
    if planned_promos is not None:
        days = days.join(planned_promos.select(*keys, "date").distinct().withColumn("_promo", F.lit(True)), [*keys, "date"], "left")
        promo = F.when(F.col("_promo"), F.col("promo_effect")).otherwise(1.0)
    holiday = F.when(fx.is_holiday("date"), F.col("holiday_effect")).otherwise(1.0)
    return days.withColumn("seasonal", trend * weekly * yearly * holiday * promo).select(
        *keys, "date", "seasonal", (F.col("seasonal") - Z90 * F.col("resid_std")).alias("lower_bound"),
        (F.col("seasonal") + Z90 * F.col("resid_std")).alias("upper_bound"))


def lookback_params(sales: DataFrame, keys=SERIES_KEYS) -> DataFrame:
    """Weighted level of the last 60 deseasonalised rows; series with fewer rows are left out."""
    w = _over(keys)
    newest = Window.partitionBy(*keys).orderBy(F.desc("date"))
    weight = F.exp(F.lit(-LOOKBACK_DECAY) * F.col("rn"))
    rows = (
        sales.select(*keys, "date", F.col("sales_qty").cast("double").alias("y"))
        .withColumns({"dow": fx.day_of_week("date"), "n": F.count(F.lit(1)).over(w), "rn": F.row_number().over(newest)})
        .withColumn("weekly", _index(F.col("y"), keys, F.col("dow")))
    )
    level = _div("y", "weekly")
    used = (F.col("rn") <= LOOKBACK_ROWS) & level.isNotNull()
    return rows.filter(F.col("n") >= LOOKBACK_ROWS).groupBy(*keys).agg(
        F.max("date").alias("last_date"),
        _div(F.sum(F.when(used, weight * level)), F.sum(F.when(used, weight))).alias("level"),
        F.array(*[F.coalesce(F.max(F.when(F.col("dow") == d, F.col("weekly"))), F.lit(1.0)) for d in range(7)]).alias("weekly"))


def lookback_forecast(params: DataFrame, horizon: int, keys=SERIES_KEYS) -> DataFrame:
    value = F.coalesce("level", F.lit(0.0)) * F.element_at("weekly", fx.day_of_week("date") + 1)
    return future_rows(params, horizon).select(*keys, "date", fx.floor_zero(value).alias("lookback"))


def seasonal_naive(sales: DataFrame, horizon: int, keys=SERIES_KEYS) -> DataFrame:
    """Sales of the same weekday a year earlier; only days whose source day exists."""
    last = F.max("date").over(_over(keys))
    steps = range(1, math.ceil(horizon / YEAR_OF_WEEKS) + 1)
    shifted = sales.select(*keys, "date", "sales_qty").withColumn("last_date", last).withColumn(
        "future", F.explode(F.array(*[F.date_add("date", YEAR_OF_WEEKS * s) for s in steps])))
    ahead = F.datediff("future", "last_date")
    source_is_newest = F.datediff("future", "date") == F.ceil(ahead / YEAR_OF_WEEKS) * YEAR_OF_WEEKS
    return shifted.filter(ahead.between(1, horizon) & source_is_newest).select(
        *keys, F.col("future").alias("date"), F.col("sales_qty").cast("double").alias("naive"))


def weighted_mean(columns, weights: dict[str, float] | None = None) -> Column:
    """Weighted mean of the members among ``columns`` that are present on a row."""
    used = {m: w for m, w in (weights or DEFAULT_WEIGHTS).items() if m in columns}
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(m) * w, F.lit(0.0)) for m, w in used.items()])
    mass = reduce(lambda a, b: a + b, [F.when(F.col(m).isNotNull(), w).otherwise(0.0) for m, w in used.items()])
    return _div(total, mass)


def ensemble(members: DataFrame, weights: dict[str, float] | None = None, model: str = "ensemble", include_ci: bool = True,
             keys=SERIES_KEYS) -> DataFrame:
    """Weighted mean of the member columns present on a row, or one chosen member."""
    value = weighted_mean(members.columns, weights) if model == "ensemble" else F.col(model)
    bound = (lambda c: F.round(c, 1)) if include_ci else (lambda c: F.lit(None).cast("double"))
    return members.select(*keys, "date", F.round(value, 1).alias("predicted_demand"), bound("lower_bound").alias("lower_bound"),
                          bound("upper_bound").alias("upper_bound"), F.lit(model).alias("model_used"))


def closed_form_members(sales: DataFrame, horizon: int, keys=SERIES_KEYS) -> DataFrame:
    """Seasonal, lookback and naive members side by side; absent values are null."""
    on = [*keys, "date"]
    seasonal = seasonal_forecast(seasonal_params(sales, keys), horizon, keys)
    return (seasonal.join(lookback_forecast(lookback_params(sales, keys), horizon, keys), on, "left")
            .join(seasonal_naive(sales, horizon, keys), on, "left"))


def seasonal_strength(sales: DataFrame, keys=SERIES_KEYS) -> DataFrame:
    """Deviation of the weekday means and of the month means, and the slope per row."""
    rows = sales.select(*keys, "date", F.col("sales_qty").cast("double").alias("y")).withColumns(
        {"i": row_index(keys).cast("double"), "dow": fx.day_of_week("date"), "mon": F.month("date")})

    def means(part: str, values) -> list[Column]:
        return [F.avg(F.when(F.col(part) == v, F.col("y"))).alias(f"{part}{v}") for v in values]

    wide = rows.groupBy(*keys).agg(*means("dow", range(7)), *means("mon", range(1, 13)),
                                   F.regr_slope("y", "i").alias("trend_slope_per_day"))

    def spread(part: str, values) -> Column:
        """Sample deviation over the present means."""
        present = F.filter(F.array(*[F.col(f"{part}{v}") for v in values]), lambda x: x.isNotNull())
        n = F.size(present)
        mean = F.aggregate(present, F.lit(0.0), lambda a, x: a + x) / n
        squares = F.aggregate(present, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
        return F.when(n > 1, F.sqrt(squares / (n - 1)))

    return wide.select(*keys, spread("dow", range(7)).alias("weekly_amplitude"),
                       spread("mon", range(1, 13)).alias("monthly_amplitude"), "trend_slope_per_day")


def tune_weights(scored: DataFrame, members=("seasonal", "naive", "lookback"), by: str = "category", step: int = 10) -> DataFrame:
    """Simplex weights with the lowest WAPE per group.

    Every candidate's error is one sum of the same aggregation: one pass, no copy of a row per candidate.
    Rows without some member are left out of the comparison.
    """
    rows = scored.na.drop(subset=["actual", *members])
    grid = [(i / step, j / step, (step - i - j) / step) for i in range(step + 1) for j in range(step + 1 - i)]
    mixes = [" + ".join(f"{m} * {w}D" for m, w in zip(members, ws)) for ws in grid]
    errors = [F.expr(f"sum(abs(actual - ({mix})))").alias(f"e{i}") for i, mix in enumerate(mixes)]
    sums = rows.groupBy(by).agg(F.sum("actual").cast("double").alias("total"), *errors)
    named = [", ".join(f"{w}D AS w_{m}" for m, w in zip(members, ws)) for ws in grid]
    candidates = [f"struct(round(e{i} / nullif(total, 0D) * 100, 6) AS wape, {names})" for i, names in enumerate(named)]
    return sums.select(by, F.expr(f"array_min(array({', '.join(candidates)}))").alias("best")).select(by, "best.*")


def fold_rows(sales: DataFrame, as_of, folds: int, horizon: int) -> DataFrame:
    """Training rows of each fold: those up to ``as_of - fold * horizon`` (expanding window)."""
    age = F.datediff(F.lit(as_of).cast("date"), "date")
    usable = F.floor(age / horizon).cast("int")
    return sales.withColumn("fold", F.explode(F.filter(
        F.sequence(F.lit(1), F.lit(folds)), lambda k: k <= usable)))


def backtest(sales: DataFrame, as_of, folds: int = 3, horizon: int = 28, model: str = "seasonal") -> DataFrame:
    """Walk-forward errors per fold. Fold k is tested on the ``horizon`` days after ``as_of - k*horizon``."""
    age = F.datediff(F.lit(as_of).cast("date"), "date")
    test_fold = F.floor(age / horizon).cast("int") + 1
    if model == "naive":
        recent = fx.trailing(sales, as_of, folds * horizon + YEAR_OF_WEEKS)
        scored = recent.withColumn("predicted", days_ago("sales_qty", YEAR_OF_WEEKS)).withColumn("fold", test_fold)
        return forecast_errors(scored.filter(F.col("fold") <= folds).withColumnRenamed("sales_qty", "actual"), ["fold"])
    keys = ["fold", *SERIES_KEYS]
    train = fold_rows(sales, as_of, folds, horizon)
    # a series may have stopped before the cutoff: forecast far enough to reach the test window
    cutoff = F.expr(f"date_sub(date'{as_of}', fold * {horizon})")
    if model == "seasonal":
        params = seasonal_params(train, keys)
        forecast = seasonal_forecast(params.withColumn("last_date", cutoff), horizon, keys)
    elif model == "lookback":
        forecast = lookback_forecast(lookback_params(train, keys).withColumn("last_date", cutoff), horizon, keys)
    else:
        raise ValueError(f"unknown model {model!r}")
    actual = sales.withColumn("fold", test_fold).filter(F.col("fold") <= folds).select(
        *keys, "date", F.col("sales_qty").alias("actual"))
    return forecast_errors(actual.join(forecast.withColumnRenamed(model, "predicted"), [*keys, "date"]), ["fold"])


def holdout_members(sales: DataFrame, as_of, horizon: int = 28, keys=SERIES_KEYS) -> DataFrame:
    """Members fitted up to ``as_of - horizon`` next to the actual sales of the days after it."""
    train = sales.filter(F.col("date") <= F.date_sub(F.lit(as_of), horizon))
    cutoff = F.date_sub(F.lit(as_of), horizon)
    on = [*keys, "date"]
    seasonal = seasonal_forecast(seasonal_params(train, keys).withColumn("last_date", cutoff), horizon, keys)
    lookback = lookback_forecast(lookback_params(train, keys).withColumn("last_date", cutoff), horizon, keys)
    naive = fx.trailing(sales, as_of, horizon + YEAR_OF_WEEKS).withColumn("naive", days_ago("sales_qty", YEAR_OF_WEEKS, keys).cast("double"))
    actual = naive.filter(F.col("date") > cutoff).select(*on, F.col("sales_qty").alias("actual"), "naive")
    return actual.join(seasonal, on, "left").join(lookback, on, "left")
