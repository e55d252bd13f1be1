"""Per-series features: lags, rolling statistics, year-over-year, calendar, densifying.

Everything is a window over (sku_id, region) ordered by date, so one exchange and one sort serve
every feature. A series has at most one row per day, which bounds a window group by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..schemas import FACT_KEYS, SERIES_KEYS

#: Lags in days, and the column lists of the feature store and of the detector.
LAGS = (7, 14, 21, 28)
FEATURE_COLUMNS = FACT_KEYS + [
    "sales_qty", "lag_7", "lag_14", "lag_21", "lag_28", "rolling_mean_7", "rolling_mean_28", "rolling_std_7",
    "day_of_week", "month", "is_holiday", "is_promotion", "weather_score", "competitor_price_delta", "yoy_ratio",
]
DETECTOR_FEATURES = [
    "daily_sales", "rolling_mean_7", "rolling_std_7", "day_of_week", "month", "is_holiday", "is_promotion",
    "weather_score", "competitor_price_delta", "lag_7", "lag_28", "yoy_ratio",
]


def series_window(keys=SERIES_KEYS, order: str = "date"):
    return Window.partitionBy(*keys).orderBy(order)


def rolling(column: str, rows: int, how: str = "mean", min_periods: int = 1, keys=SERIES_KEYS) -> Column:
    """Statistic of the ``rows`` rows before the current one; null below ``min_periods`` rows."""
    frame = series_window(keys).rowsBetween(-rows, -1)
    value = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum}[how](F.col(column)).over(frame)
    if min_periods <= 1:
        return value
    return F.when(F.count(F.col(column)).over(frame) >= min_periods, value)


def days_ago(column: str, days: int, keys=SERIES_KEYS) -> Column:
    """Value exactly ``days`` calendar days earlier in the same series, null when that day is absent.

    A one-day RANGE frame over the day number replaces a date-shifted self-join: same result on a
    unique (series, date) key, without a second scan and shuffle.
    """
    by_day = Window.partitionBy(*keys).orderBy(F.unix_date("date")).rangeBetween(-days, -days)
    return F.max(F.col(column)).over(by_day)


def yoy_ratio(column: str = "sales_qty") -> Column:
    return F.col(column).cast("double") / (days_ago(column, 365) + 1)


def row_index(keys=SERIES_KEYS) -> Column:
    return F.row_number().over(series_window(keys)) - 1


def densify(sales: DataFrame, keys=SERIES_KEYS) -> DataFrame:
    """Every calendar day between the first and last row of each series; missing days sell 0.

    Each row expands to itself plus the gap before its successor, so no calendar table is joined and
    the series partitioning is kept.
    """
    following = F.lead("date").over(series_window(keys))
    gap = F.sequence(F.col("date"), F.coalesce(F.date_sub(following, 1), F.col("date")))
    spread = sales.withColumn("_days", gap).withColumn("_day", F.explode("_days"))
    real = F.col("_day") == F.col("date")
    fills = {"sales_qty": F.lit(0).cast("long"), "revenue_inr": F.lit(0).cast("decimal(14,2)"),
             "returns_qty": F.lit(0).cast("long"), "is_holiday": fx.is_holiday("_day"), "is_promotion": F.lit(False)}
    changed = {n: F.when(real, F.col(n)).otherwise(v) for n, v in fills.items() if n in sales.columns}
    for name in ("promo_id", "weather_score"):
        if name in sales.columns:
            changed[name] = F.when(real, F.col(name))
    return spread.withColumns(changed).withColumn("date", F.col("_day")).drop("_days", "_day")


def daily_competitor(competitor: DataFrame) -> DataFrame:
    """One price delta per (sku, date): the raw feed repeats keys and would multiply fact rows."""
    return competitor.groupBy("sku_id", "date").agg(
        F.avg(F.col("price_delta_pct").cast("double")).alias("competitor_price_delta"))


def enrich(sales: DataFrame, weather: DataFrame, competitor: DataFrame) -> DataFrame:
    """Weather and competitor columns on the fact, 0.0 where absent.

    No broadcast is forced: both sides grow with the calendar, so Catalyst and AQE decide from their
    measured size and fall back to a shuffled join with skew splitting.
    """
    scores = weather.select("region", "date", F.col("score").cast("double").alias("weather_score"))
    return (
        sales.drop("weather_score").join(scores, ["region", "date"], "left")
        .join(daily_competitor(competitor), ["sku_id", "date"], "left")
        .na.fill({"weather_score": 0.0, "competitor_price_delta": 0.0})
    )


def between_dates(df: DataFrame, run_date, lookback: int) -> DataFrame:
    """Rows of [run_date - lookback, run_date]."""
    return fx.trailing(df, run_date, lookback).filter(F.col("date") <= F.lit(fx.as_day(run_date)))


def build_features(sales: DataFrame, weather: DataFrame, competitor: DataFrame, run_date, lookback: int = 400,
                   mode: str = "rows", min_periods: int | str = 1) -> DataFrame:
    """Feature-store rows for the lookback window.

    ``mode="rows"`` counts rows (lag 7 = seven rows back); ``mode="calendar"`` first fills missing days.
    ``min_periods`` is the number of earlier rows a rolling value needs, "full" for the whole frame.
    """
    if mode not in ("rows", "calendar"):
        raise ValueError("mode is 'rows' or 'calendar'")
    base = between_dates(sales, run_date, lookback).select(*FACT_KEYS, "sales_qty", "is_holiday", "is_promotion")
    if mode == "calendar":
        base = densify(base)
    df = enrich(base, between_dates(weather, run_date, lookback), between_dates(competitor, run_date, lookback))
    w = series_window()
    short, long = (7, 28) if min_periods == "full" else (min_periods, min_periods)
    return (
        df.withColumns({f"lag_{n}": F.lag("sales_qty", n).over(w) for n in LAGS})
        .withColumns({
            "rolling_mean_7": rolling("sales_qty", 7, "mean", short),
            "rolling_mean_28": rolling("sales_qty", 28, "mean", long),
            "rolling_std_7": rolling("sales_qty", 7, "std", short),
            "yoy_ratio": yoy_ratio(),
            "day_of_week": fx.day_of_week("date"), "month": F.month("date"),
        })
        .na.drop(subset=["lag_7", "rolling_mean_7"])
        .select(*FEATURE_COLUMNS)
    )


def detector_features(enriched: DataFrame, min_periods: int = 3) -> DataFrame:
    """Detector matrix per series-day; optional inputs that are absent become 0."""
    df = fx.ensure_columns(enriched, {"is_holiday": False, "is_promotion": False, "weather_score": 0.0,
                                      "competitor_price_delta": 0.0})
    w = series_window()
    return (
        df.withColumns({
            "daily_sales": F.col("sales_qty").cast("double"),
            "rolling_mean_7": rolling("sales_qty", 7, "mean", min_periods),
            "rolling_std_7": F.coalesce(rolling("sales_qty", 7, "std", min_periods), F.lit(1.0)),
            "lag_7": F.lag("sales_qty", 7).over(w), "lag_28": F.lag("sales_qty", 28).over(w),
            "yoy_ratio": yoy_ratio(),
            "day_of_week": fx.day_of_week("date"), "month": F.month("date"),
            "series_rows": F.count(F.lit(1)).over(Window.partitionBy(*SERIES_KEYS)),
        })
        .na.drop(subset=["rolling_mean_7", "lag_7"])
        .withColumns({"lag_28": F.coalesce(F.col("lag_28").cast("double"), F.col("rolling_mean_7")),
                      "yoy_ratio": F.coalesce("yoy_ratio", F.lit(1.0))})
    )


def forecaster_features(sales: DataFrame) -> DataFrame:
    """Forecaster matrix: full 7- and 28-row windows required, every incomplete row dropped."""
    w = series_window()
    out = (
        sales.select(*FACT_KEYS, "sales_qty", "is_holiday", F.col("is_promotion").alias("promo_active"))
        .withColumns({f"lag_{n}": F.lag("sales_qty", n).over(w) for n in LAGS})
        .withColumns({
            "rolling_mean_7": rolling("sales_qty", 7, "mean", 7), "rolling_mean_28": rolling("sales_qty", 28, "mean", 28),
            "rolling_std_7": rolling("sales_qty", 7, "std", 7),
            "day_of_week": fx.day_of_week("date"), "month": F.month("date"),
        })
    )
    return out.na.drop()


def two_sigma_flags(sales: DataFrame, rows: int = 28, sigmas: float = 2.0, min_periods: int = 7) -> DataFrame:
    """Days outside mean +/- ``sigmas`` std of the preceding rows."""
    banded = sales.select(*FACT_KEYS, "sales_qty").withColumns({
        "band_mean": rolling("sales_qty", rows, "mean", min_periods),
        "band_std": rolling("sales_qty", rows, "std", min_periods)})
    outside = F.abs(F.col("sales_qty") - F.col("band_mean")) > F.lit(sigmas) * F.col("band_std")
    return banded.na.drop(subset=["band_mean", "band_std"]).withColumn("outside", outside)


def inventory_drop(inventory_daily: DataFrame) -> DataFrame:
    """Day-over-day stock drop in percent, 0 when stock rose."""
    prev = F.lag("quantity_on_hand").over(series_window())
    drop = fx.pct(prev - F.col("quantity_on_hand"), prev)
    return inventory_daily.select(*FACT_KEYS, "quantity_on_hand", F.greatest(F.lit(0.0), F.coalesce(drop, F.lit(0.0)))
                                  .alias("inventory_drop_pct"))
