"""Prediction intervals by split conformal calibration.

The residuals of a member on days it was not fitted on, relative to the level of their series, are pooled by
(member, week ahead). The interval of level 1 - a is the prediction plus and minus the ceil((n + 1)(1 - a))-th
smallest of n such scores times the level: it covers at least that share of exchangeable days, whatever the
distribution of the errors. The order statistic is exact and computed without a task that holds a whole pool.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..schemas import SERIES_KEYS
from .order_stats import order_statistic

COVERAGE, STEP_DAYS = 0.9, 7


def series_level(sales: DataFrame, keys=SERIES_KEYS) -> DataFrame:
    """keys, level: mean sales of a series, 1 at least, the unit its errors are measured in."""
    return sales.groupBy(*keys).agg(F.greatest(F.avg("sales_qty").cast("double"), F.lit(1.0)).alias("level"))


def week_ahead(date: str | Column, cutoff) -> Column:
    """0 for the first seven days after ``cutoff``, 1 for the next."""
    return F.floor((F.datediff(fx._c(date), F.lit(cutoff).cast("date")) - 1) / STEP_DAYS).cast("int")


def calibrate(held: DataFrame, levels: DataFrame, cutoff, members: list[str], coverage: float = COVERAGE, keys=SERIES_KEYS) -> DataFrame:
    """(member, week, n, width): width in levels of the series. ``held`` has keys, date, actual and the members.

    A pool too small for the coverage asked for has no row.
    """
    scores = held.join(levels, list(keys)).select(
        week_ahead("date", cutoff).alias("week"), "level", "actual", F.explode(F.create_map(*[x for m in members for x in (F.lit(m), F.col(m).cast("double"))])).alias("member", "predicted"))
    scores = scores.filter("predicted IS NOT NULL AND actual IS NOT NULL").select(
        "member", "week", (F.abs(F.col("actual") - F.col("predicted")) / F.col("level")).alias("score"))
    share = math.floor(coverage * 1e6)
    place = F.ceil((F.col("n") + 1) * share / 1_000_000)
    return order_statistic(scores, ["member", "week"], "score", place, "width")


def with_intervals(points: DataFrame, widths: DataFrame, levels: DataFrame, cutoff, member: str, value: str = "predicted_demand", keys=SERIES_KEYS) -> DataFrame:
    """``points`` (keys, date, ``value``) with lower_bound (0 at least) and upper_bound of ``member``.

    Weeks beyond the calibrated ones take the widest of these; without any, the bounds are null.
    """
    own = widths.filter(F.col("member") == member)
    farthest = own.groupBy("member").agg(F.max("width").alias("widest"), F.max("week").alias("last"))
    rows = points.drop("lower_bound", "upper_bound").join(levels, list(keys), "left").withColumn("week", week_ahead("date", cutoff)).withColumn("member", F.lit(member))
    rows = rows.join(own.select("week", "width"), "week", "left").join(farthest, "member", "left")
    width = F.coalesce("width", F.when(F.col("week") > F.col("last"), F.col("widest"))) * F.col("level")
    return rows.withColumns({"lower_bound": F.greatest(F.col(value) - width, F.when(width.isNotNull(), F.lit(0.0))), "upper_bound": F.col(value) + width}).select(
        *[c for c in points.columns if c not in ("lower_bound", "upper_bound")], "lower_bound", "upper_bound")
