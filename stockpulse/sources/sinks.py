"""Writers: daily and monthly partitions, insert-if-absent, update-from, view refresh, load counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalar as fx


def overwrite_months(df: DataFrame, path: str, date_column: str = "date") -> None:
    """Replace only the months present in ``df``; a rerun of the same months gives the same table."""
    (df.withColumn(fx.MONTH_PARTITION, fx.month_key(date_column)).hint("rebalance", fx.MONTH_PARTITION)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(fx.MONTH_PARTITION).parquet(path))


def overwrite_days(df: DataFrame, path: str, date_column: str = "date") -> None:
    """Replace only the days present in ``df``; other days of their months stay, a replay changes nothing."""
    (df.hint("rebalance", date_column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_column).parquet(path))


def replace_table(df: DataFrame, path: str, date_column: str = "date") -> None:
    """Replace the whole table; months that ``df`` has no rows for go."""
    (df.withColumn(fx.MONTH_PARTITION, fx.month_key(date_column)).hint("rebalance", fx.MONTH_PARTITION)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(fx.MONTH_PARTITION).parquet(path))


def as_declared(df: DataFrame, table: str) -> DataFrame:
    """Columns in declared order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.TABLES[table] if f.name in df.columns])


def write_features(features: DataFrame, path: str) -> int:
    """Write the feature store by day and return the row count, observed while writing."""
    counted, seen = with_row_count(as_declared(features, "feature_store"))
    overwrite_days(counted, path)
    return seen.get["rows"]


def with_row_count(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Row count (and further aggregates) of a load without a second pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]), seen


def dedupe_latest(df: DataFrame, keys, order_by) -> DataFrame:
    """Newest row per key; ``order_by`` columns must order the rows of a key totally.

    An aggregate rather than a ranking: each task keeps one candidate per key, so a key holding many
    copies is reduced before the shuffle. An order over all other columns is the row itself and goes once.
    """
    order = F.struct(*[F.col(c) for c in order_by])
    others = [c for c in df.columns if c not in keys]
    whole = set(others) <= set(order_by)
    rest = F.struct(*[F.col(c) for c in others])
    kept = df.groupBy(*keys).agg((F.max(order) if whole else F.max_by(rest, order)).alias("_row"))
    return kept.select(*keys, *[F.col("_row")[c].alias(c) for c in others]).select(*df.columns)


def append_absent(new: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Rows to insert: one per key, none that the target already has."""
    return new.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")


def upsert_absent(new: DataFrame, target: DataFrame, keys) -> DataFrame:
    return target.unionByName(append_absent(new, target, keys))


def update_from(target: DataFrame, source: DataFrame, keys, column: str, value: Column, where: Column | None = None) -> DataFrame:
    """New snapshot of ``target`` with ``column`` set from the matching source row.

    Only null cells (and only rows meeting ``where``) change. ``source`` has one row per key and no
    other column in common with the target.
    """
    matched = F.col("_hit").isNotNull() & F.col(column).isNull()
    if where is not None:
        matched = matched & where
    joined = target.join(source.withColumn("_hit", F.lit(True)), list(keys), "left")
    return joined.withColumn(column, F.when(matched, value).otherwise(F.col(column))).select(*target.columns)


def realize_forecasts(forecasts: DataFrame, sales: DataFrame, as_of) -> DataFrame:
    """Fill the realized error of yesterday's targets, matched on region as well as sku and date."""
    actual = sales.select("sku_id", "region", F.col("date").alias("target_date"), "sales_qty")
    error = fx.abs_pct_error("sales_qty", "predicted_qty")
    return update_from(forecasts.withColumn("realized_mape", F.col("realized_mape").cast("double")), actual,
                       ["sku_id", "region", "target_date"], "realized_mape", error,
                       F.col("target_date") == F.date_sub(F.lit(as_of), 1))


def sync_inventory(raw: DataFrame, path: str) -> int:
    """Daily snapshot load: one row per (sku, warehouse, date), replacing the days it covers."""
    keys = ["sku_id", "warehouse_id", "snapshot_date"]
    order = ["loaded_at"] if "loaded_at" in raw.columns else []
    unique = dedupe_latest(raw, keys, order + [c for c in raw.columns if c not in keys + order])
    counted, seen = with_row_count(unique)
    overwrite_days(counted, path, "snapshot_date")
    return seen.get["rows"]


def refresh_views(kpis: DataFrame, regional_of, path: str) -> None:
    """Rebuild both KPI tables whole and in order; the regional one reads the stored daily one."""
    replace_table(kpis, f"{path}/sku_daily_kpis")
    stored = kpis.sparkSession.read.parquet(f"{path}/sku_daily_kpis").drop(fx.MONTH_PARTITION)
    replace_table(regional_of(stored), f"{path}/regional_kpis")
