"""Daily, regional and monthly views kept up to date by the days that changed.

Loads leave a list of the days they touched. A refresh takes the lists it has not applied, recomputes those days
alone and puts them in place of the stored ones, month partition by month partition; monthly figures are sums of
stored regional days, so a month costs its days and not its sales. Other months are not opened for writing: their
files stay as they are. Applying a list is
idempotent and it is marked as applied last, so a refresh that dies is simply run again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..operators import kpis
from ..session import discard, file_system, stage

#: Additive parts of a regional day; every monthly figure is a ratio of their sums.
PARTS = ["rows", "total_sales", "total_predicted_demand", "mape_sum", "mape_rows", "stockout_events", "overstock_events"]


def record_load(days: DataFrame, path: str, number: int) -> None:
    """Note the days (date) that load ``number`` touched; a replayed load replaces its own list."""
    days.select("date").distinct().coalesce(1).write.mode("overwrite").parquet(f"{path}/loads/load={number}")


def _numbers(spark: SparkSession, path: str, folder: str, prefix: str) -> set[int]:
    fs, where = file_system(spark, f"{path}/{folder}")
    if not fs.exists(where):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return {int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and (prefix == "applied-" or fs.exists(where.suffix(f"/{n}/_SUCCESS")))}


def pending(spark: SparkSession, path: str) -> list[int]:
    """Loads that were noted completely and not applied yet."""
    return sorted(_numbers(spark, path, "loads", "load=") - _numbers(spark, path, "applied", "applied-"))


def regional_parts(daily: DataFrame) -> DataFrame:
    """Sums and counts of one region and day."""
    return daily.groupBy("region", "date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("actual_sales").alias("total_sales"), F.sum("predicted_demand").alias("total_predicted_demand"),
        F.sum("mape").alias("mape_sum"), F.count("mape").alias("mape_rows"), F.sum("stockout_events").alias("stockout_events"),
        F.sum("overstock_events").alias("overstock_events"))


def figures(parts: DataFrame) -> DataFrame:
    """The columns of the regional view from its additive parts."""
    mape = fx.ratio("mape_sum", "mape_rows")
    return parts.select("region", "date", "total_sales", "total_predicted_demand", mape.alias("avg_mape"), (F.lit(100.0) - mape).alias("forecast_accuracy_pct"),
                        "stockout_events", "overstock_events", F.round((F.lit(1.0) - F.col("stockout_events") / F.col("rows")) * 100, 2).alias("fulfillment_rate"))


def _months(parts: DataFrame) -> DataFrame:
    sums = parts.groupBy("region", fx.month_key("date").alias(fx.MONTH_PARTITION)).agg(*[F.sum(c).alias(c) for c in PARTS])
    mape = fx.ratio("mape_sum", "mape_rows")
    return sums.select("region", "rows", "total_sales", "total_predicted_demand", mape.alias("avg_mape"), "stockout_events", "overstock_events", fx.MONTH_PARTITION)


def _replace(df: DataFrame, path: str, touched: DataFrame | None, months: list[str]) -> None:
    """Put ``df`` in place of the stored rows of the ``touched`` days (all of ``months``, if None); months left without rows go."""
    spark, month = df.sparkSession, fx.MONTH_PARTITION
    fs, where = file_system(spark, path)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema if f.name != month)}, {month} string"
    rows = df if month in df.columns else df.withColumn(month, fx.month_key("date"))
    if touched is not None and fs.exists(where):
        kept = spark.read.schema(schema).parquet(path).filter(F.col(month).isin(months)).join(touched, "date", "left_anti")
        rows = rows.unionByName(kept)
    rows = stage(rows, "replaced-months")  # a partition cannot be read while it is overwritten
    rows.hint("rebalance", month).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)
    left = {r[0] for r in rows.select(month).distinct().collect()}  # months of the pending loads at most
    for value in set(months) - left:
        fs.delete(where.suffix(f"/{month}={value}"), True)
    discard(rows)


def _stored(spark: SparkSession, path: str, months: list[str]) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.withColumn(fx.MONTH_PARTITION, F.col(fx.MONTH_PARTITION).cast("string")).filter(F.col(fx.MONTH_PARTITION).isin(months)).drop(fx.MONTH_PARTITION)


def refresh(spark: SparkSession, path: str, sources: Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]]) -> list[dt.date]:
    """Bring the views under ``path`` up to date; returns the days that were recomputed.

    ``sources`` gives (sales, forecasts, inventory) of the days (date) it is handed. The list of days is bounded by
    the days of the pending loads; rows never come to the driver.
    """
    loads = pending(spark, path)
    if not loads:
        return []
    days = spark.read.schema("date date").parquet(*[f"{path}/loads/load={n}" for n in loads]).distinct()
    touched = sorted(r["date"] for r in days.filter("date IS NOT NULL").collect())
    if touched:
        dirty, months = stage(days, "dirty-days"), sorted({f"{d:%Y-%m}" for d in touched})
        daily = kpis.sku_daily_kpis(*sources(dirty)).join(dirty, "date", "left_semi")
        _replace(daily, f"{path}/sku_daily_kpis", dirty, months)
        stored = _stored(spark, f"{path}/sku_daily_kpis", months)
        _replace(regional_parts(stored.join(dirty, "date", "left_semi")), f"{path}/regional_parts", dirty, months)
        _replace(_months(_stored(spark, f"{path}/regional_parts", months)), f"{path}/regional_months", None, months)
    for n in loads:
        fs, where = file_system(spark, f"{path}/applied/applied-{n}")
        fs.create(where, True).close()
    return touched


def regional_view(spark: SparkSession, path: str) -> DataFrame:
    return figures(spark.read.parquet(f"{path}/regional_parts"))
