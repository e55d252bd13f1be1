"""Derives the retail star schema from order-line tables.

``load`` gives one object with every table as a DataFrame. The daily fact is aggregated from the
order lines once per session and written, partitioned by month, to the shared folder: every later
query prunes months and columns from it instead of repeating the joins over all order lines, and a
lost executor costs a re-read, not a re-join. The other tables are narrow derivations of it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalar as fx
from ..session import scratch_path

CATEGORIES = ["Electronics", "Apparel", "Grocery", "Home & Kitchen", "Sports"]
HISTORY_DAYS = 400
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
#: Campaign rows covering every combination of "null means all".
PROMOTION_ROWS = [
    ("P1", "Everything week", "discount", "10.00", "1996-03-01", "1996-03-07", None, None),
    ("P2", "Brand pair", "bogo", "25.00", "1997-06-01", "1997-06-30", ["Brand#1", "Brand#2"], None),
    ("P3", "Asia month", "discount", "15.00", "1998-09-01", "1998-09-30", None, ["ASIA"]),
    ("P4", "Targeted", "bundle", "20.00", "1999-02-01", "1999-03-31", ["Brand#3", "Brand#4", "Brand#5"], ["EUROPE", "AFRICA"]),
    ("P5", "One day", "discount", "30.00", "2000-08-15", "2000-08-15", None, None),
    ("P6", "Overlap A", "loyalty", "5.00", "2001-01-10", "2001-02-10", ["Brand#7"], None),
    ("P7", "Overlap B", "discount", "12.50", "2001-02-01", "2001-02-28", ["Brand#7", "Brand#8"], ["AMERICA"]),
    ("P8", "No sales", "discount", "50.00", "2010-01-01", "2010-01-31", ["Brand#999"], None),
]


def sku_number(sku: str | Column = "sku_id") -> Column:
    return F.regexp_extract(fx._c(sku), r"([0-9]+)", 1).cast("long")


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def region_names(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, root, "region").select("r_regionkey", F.col("r_name").alias("region"))


def _sku_lines(spark: SparkSession, root: str, grain: str, *columns: str) -> DataFrame:
    """Order lines with their sku_id. Brand grain joins the product table, part grain needs no join."""
    lines = _table(spark, root, "lineitem").select("l_partkey", *columns)
    if grain == "part":
        return lines.withColumn("sku_id", F.concat(F.lit("SKU-"), "l_partkey"))
    brands = _table(spark, root, "part").select("p_partkey", F.col("p_brand").alias("sku_id"))
    return lines.join(brands, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


def lines(spark: SparkSession, root: str, grain: str = "brand") -> DataFrame:
    """Order lines with sku_id and region; columns that a caller does not use are pruned from the scans."""
    order_region = (
        _table(spark, root, "orders").select("o_orderkey", "o_custkey")
        .join(_table(spark, root, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_table(spark, root, "nation").select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region_names(spark, root), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "region")
    )
    own = _sku_lines(spark, root, grain, *LINE_COLUMNS)
    return own.join(order_region, F.col("l_orderkey") == F.col("o_orderkey"))


def daily_sales(spark: SparkSession, root: str, grain: str = "brand") -> DataFrame:
    """Order lines to one row per sku x region x date.

    Shuffles: one per large equi-join key (part, order, customer) and one for the grouping, which
    combines map-side first. Hot join keys are split by AQE's skew join; a hot group shrinks to one
    partial row per task before it is shuffled.
    """
    joined = lines(spark, root, grain)
    qty = F.col("l_quantity").cast("long")
    paise = F.floor(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) * 100 + 0.5)
    return (
        joined.groupBy("sku_id", "region", F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.sum(qty).alias("sales_qty"),
            F.sum(paise).alias("paise"),
            F.sum(F.when(F.col("l_returnflag") == "R", qty).otherwise(0)).alias("returns_qty"),
            (F.max("l_discount") >= 0.09).alias("is_promotion"),
        )
        .select(
            "sku_id", "region", "date", "sales_qty",
            (F.col("paise").cast("decimal(18,0)") / 100).cast("decimal(14,2)").alias("revenue_inr"),
            "returns_qty", fx.is_holiday("date").alias("is_holiday"), "is_promotion",
            F.lit(None).cast("string").alias("promo_id"),
            F.lit(None).cast("decimal(6,3)").alias("weather_score"),
        )
    )


@dataclass
class RetailTables:
    """The retail tables over one source folder."""

    spark: SparkSession
    root: str
    grain: str

    @cached_property
    def sales(self) -> DataFrame:
        """The daily fact, written once and read back."""
        return self.spark.read.parquet(build_sales(self.spark, self.root, self.grain))

    @cached_property
    def as_of(self) -> dt.date:
        """Newest day of the fact; stands in for today."""
        return self.sales.agg(F.max("date")).first()[0]

    @cached_property
    def _region_keys(self) -> DataFrame:
        return region_names(self.spark, self.root).withColumnRenamed("r_regionkey", "rk")

    @cached_property
    def products(self) -> DataFrame:
        part = _table(self.spark, self.root, "part")
        if self.grain == "part":
            keyed = part.select(F.concat(F.lit("SKU-"), "p_partkey").alias("sku_id"), "p_name", "p_brand", "p_retailprice")
            base = keyed.select("sku_id", "p_name", "p_brand", F.floor(F.col("p_retailprice") * 60 + 0.5).alias("cost"),
                                F.floor(F.col("p_retailprice") * 100 + 0.5).alias("price"))
        else:
            base = part.groupBy(F.col("p_brand").alias("sku_id")).agg(
                F.min("p_name").alias("p_name"), F.first("p_brand").alias("p_brand"),
                F.floor(F.avg(F.floor(F.col("p_retailprice") * 100 + 0.5)) * 0.6 + 0.5).alias("cost"),
                F.floor(F.avg(F.floor(F.col("p_retailprice") * 100 + 0.5)) + 0.5).alias("price"))
        number = sku_number()
        categories = F.array(*[F.lit(c) for c in CATEGORIES])
        return base.select(
            "sku_id", F.col("p_name").alias("product_name"),
            F.element_at(categories, (number % 5 + 1).cast("int")).alias("category"),
            F.lit(None).cast("string").alias("subcategory"), F.col("p_brand").alias("brand"),
            (F.col("cost").cast("decimal(12,0)") / 100).cast("decimal(10,2)").alias("unit_cost_inr"),
            (F.col("price").cast("decimal(12,0)") / 100).cast("decimal(10,2)").alias("unit_price_inr"),
            F.lit(None).cast("decimal(6,3)").alias("weight_kg"), (number % 12 != 0).alias("is_active"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        return (
            self.sales.select("region", "date").distinct().join(self._region_keys, "region")
            .select("region", "date",
                    (((F.dayofyear("date") * 7 + F.col("rk") * 13) % 41).cast("double") / 10 - 2)
                    .cast("decimal(5,3)").alias("score"))
        )

    @cached_property
    def competitor(self) -> DataFrame:
        """Several rows per (sku, date) on purpose: there is no unique key on this table."""
        lines = _sku_lines(self.spark, self.root, self.grain, "l_linenumber", "l_tax", "l_shipdate")
        return lines.filter(F.col("l_linenumber") == 7).select(
            "sku_id", F.col("l_shipdate").cast("date").alias("date"),
            ((F.floor(F.col("l_tax") * 100 + 0.5) - 4) * 5).cast("decimal(7,3)").alias("price_delta_pct"))

    @cached_property
    def series(self) -> DataFrame:
        """Distinct (sku, region) with their numbers."""
        return (self.sales.select("sku_id", "region").distinct().join(self._region_keys, "region")
                .withColumn("bn", sku_number()))

    @cached_property
    def inventory(self) -> DataFrame:
        """Two warehouses per series, one row a day over the last 400 days."""
        first = self.as_of - dt.timedelta(days=HISTORY_DAYS - 1)
        days = F.sequence(F.lit(first), F.lit(self.as_of))
        doy, bn, rk, w = F.dayofyear("snapshot_date"), F.col("bn"), F.col("rk"), F.col("w")
        return (
            self.series.withColumn("snapshot_date", F.explode(days))
            .withColumn("w", F.explode(F.array(F.lit(0), F.lit(1))))
            .join(self.products.select("sku_id", "unit_cost_inr"), "sku_id")
            .select(
                "sku_id", F.concat(F.lit("WH-"), rk.cast("string"), F.lit("-"), w.cast("string")).alias("warehouse_id"),
                "region", "snapshot_date",
                F.when((bn * 7 + rk * 11 + doy) % 29 == 0, 0).otherwise((bn * 37 + rk * 53 + doy * 17 + w * 101) % 400)
                .cast("int").alias("quantity_on_hand"),
                F.lit(0).alias("quantity_on_order"), F.lit(0).alias("quantity_reserved"),
                (60 + (bn * 10) % 140).cast("int").alias("reorder_point"),
                (2 + bn % 13).cast("smallint").alias("lead_time_days"), "unit_cost_inr",
            )
        )

    @cached_property
    def forecasts(self) -> DataFrame:
        """Two vintages and two models per target day over the last 400 days."""
        recent = fx.trailing(self.sales, self.as_of, HISTORY_DAYS - 1)
        bn, rk, doy, lead, m = sku_number(), F.col("rk"), F.dayofyear("date"), F.col("lead"), F.col("m")
        noise = (bn + rk + doy * (1 + 2 * m) + lead) % (11 + 6 * m) - (5 + 3 * m)
        predicted = F.greatest(F.lit(0), F.col("sales_qty") + noise).cast("decimal(12,1)")
        error = F.round(fx.abs_pct_error("sales_qty", "predicted_qty"), 3)
        return (
            recent.join(self._region_keys, "region")
            .withColumn("lead", F.explode(F.array(F.lit(1), F.lit(7))))
            .withColumn("m", F.explode(F.array(F.lit(0), F.lit(1))))
            .withColumn("predicted_qty", predicted)
            .select(
                "sku_id", "region", F.expr("date_sub(date, lead)").alias("forecast_date"),
                F.col("date").alias("target_date"), "predicted_qty",
                F.when(m == 0, "ensemble").otherwise("naive").alias("model_name"),
                F.concat(F.lit("v"), lead.cast("string")).alias("model_version"),
                F.when(doy % 2 == 0, error).alias("realized_mape"),
            )
        )

    @cached_property
    def promotions(self) -> DataFrame:
        """The campaigns as a local table: Spark knows its size, so that joins with the fact need not shuffle the fact."""
        rows = [(i, n, k, Decimal(p), dt.date.fromisoformat(s), dt.date.fromisoformat(e), skus, regions)
                for i, n, k, p, s, e, skus, regions in PROMOTION_ROWS]
        columns = dict(zip(schemas.PROMOTIONS.names, map(list, zip(*rows))))
        return self.spark.createDataFrame(pa.table(columns), schemas.PROMOTIONS)

    @cached_property
    def model_versions(self) -> DataFrame:
        """One version per model and quarter of targets, with the errors measured in that quarter."""
        quarter = (F.year("target_date") * 4 + F.quarter("target_date") - 1)
        actual = self.sales.select("sku_id", "region", F.col("date").alias("target_date"), "sales_qty")
        scored = self.forecasts.join(actual, ["sku_id", "region", "target_date"])
        error = F.col("predicted_qty").cast("double") - F.col("sales_qty")
        oldest = (self.as_of - dt.timedelta(days=HISTORY_DAYS - 1))
        first_version = oldest.year * 4 + (oldest.month - 1) // 3
        return (
            scored.groupBy("model_name", quarter.alias("version"))
            .agg(F.round(F.avg(fx.abs_pct_error("sales_qty", "predicted_qty")), 3).alias("avg_mape"),
                 F.round(F.sqrt(F.avg(error * error)), 2).alias("avg_rmse"))
            .withColumn("stage", F.when(F.col("version") == first_version, "Production").otherwise("Staging"))
            .select("model_name", "version", "stage", "avg_mape", "avg_rmse")
        )


_built: dict[tuple, RetailTables] = {}


def build_sales(spark: SparkSession, root: str, grain: str = "brand") -> str:
    """Aggregate and write the daily fact; returns its path.

    The rebalance hint gathers a month's rows for few, large files, and AQE splits a month that is
    too big for one task.
    """
    path = scratch_path(spark, f"sku_daily_sales_{grain}")
    (daily_sales(spark, root, grain).withColumn(fx.MONTH_PARTITION, fx.month_key("date"))
     .hint("rebalance", fx.MONTH_PARTITION).sortWithinPartitions(fx.MONTH_PARTITION, "sku_id", "region", "date")
     .write.partitionBy(fx.MONTH_PARTITION).parquet(path))
    return path


def load(spark: SparkSession, root: str, grain: str = "brand", refresh: bool = False) -> RetailTables:
    """Retail tables over ``root``; the daily fact is built when a query first needs it in this session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, root, grain)
    if refresh or key not in _built:
        _built[key] = RetailTables(spark, root, grain)
    return _built[key]
