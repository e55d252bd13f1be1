"""Shape of the physical plans, with broadcasting off: what a large input gets."""

import re

import pytest
from conftest import SF, plan_of
from pyspark.sql import functions as F

from stockpulse.functions import scalar as fx
from stockpulse.operators import features, forecasting, monitoring, promotions
from stockpulse.plans.queries import REGISTRY
from stockpulse.sources import retail

#: Queries that run jobs while they are built, so that building them again only for the plan is slow.
EAGER = {"gbt_forecast", "forecast_ensemble", "sku_clusters", "sku_clusters_part", "match_controls", "detect_anomalies",
         "attribute_spikes", "attribute_spikes_boosted", "fitted_weights", "backtest_boosted", "backtest_members", "trained_model_errors", "served_forecast",
         "months_incremental"}


@pytest.fixture
def unbroadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if n not in EAGER and not n.startswith("stream")))
def test_no_pairs_no_python_no_global_window(unbroadcast, name):
    plan = plan_of(REGISTRY[name](unbroadcast, SF))
    assert "Cartesian" not in plan and "NestedLoop" not in plan, "all joins are equi-joins"
    assert "Python" not in plan and "Pandas" not in plan, "rows stay in the JVM"
    assert "BroadcastHashJoin" not in plan, "no join depends on a forced broadcast"
    for window in re.findall(r"Window \[.*?\], \[(.*?)\]", plan):
        assert window.strip(), "every window has a partition key"


def test_series_work_costs_one_exchange(unbroadcast, tables):
    sales = tables.sales
    w = features.series_window()
    assert exchanges(plan_of(sales.select("sku_id", "region", "date", features.rolling("sales_qty", 7).alias("m"),
                                          features.yoy_ratio().alias("y"), F.lag("sales_qty", 7).over(w).alias("l")))) == 1
    assert exchanges(plan_of(forecasting.seasonal_forecast(forecasting.seasonal_params(sales), 28))) == 1
    assert exchanges(plan_of(forecasting.lookback_forecast(forecasting.lookback_params(sales), 28))) == 1
    assert exchanges(plan_of(features.two_sigma_flags(features.densify(sales.select("sku_id", "region", "date", "sales_qty"))))) == 1
    inv = sales.select("sku_id", "region", "date", F.col("sales_qty").alias("quantity_on_hand"))
    assert exchanges(plan_of(monitoring.stock_spells(inv))) == 1


def test_months_and_rows_are_pruned(tables):
    plan = tables.sales.transform(lambda d: fx.trailing(d, tables.as_of, 30)).select("sku_id", "sales_qty")
    text = plan_of(plan)
    assert re.search(r"PartitionFilters: \[.*part_month.* >= 2001-10", text)
    assert "GreaterThanOrEqual(date" in text
    assert re.search(r"ReadSchema: struct<sku_id:string,date:date,sales_qty:bigint>", text)


def test_order_lines_are_pruned(spark):
    plan = plan_of(retail.daily_sales(spark, SF))
    line = [x for x in plan.splitlines() if "FileScan parquet" in x and "l_orderkey" in x][0]
    for unused in ("l_suppkey", "l_linenumber", "l_tax", "l_linestatus"):
        assert unused not in line


def test_fact_writer_splits_big_months(spark):
    df = retail.daily_sales(spark, SF).withColumn(fx.MONTH_PARTITION, fx.month_key("date")).hint("rebalance", fx.MONTH_PARTITION)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(df)


def test_campaign_join_has_no_range_condition(unbroadcast, tables):
    plan = plan_of(promotions.expand_promotions(tables.sales, tables.promotions))
    assert plan.count("SortMergeJoin") == 3 and not re.search(r"SortMergeJoin.*<=", plan)


def test_campaigns_and_trailing_queries_open_only_their_months(tables):
    plan = plan_of(promotions.expand_promotions(tables.sales, tables.promotions))
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and "revenue_inr" in x]
    assert len(scans) == 3 and all(re.search(r"PartitionFilters: \[[^\]]*part_month", x) for x in scans)
    for name in ("stockout_reduction", "regional_flags", "realized_mape", "backtest_naive"):
        plan = plan_of(REGISTRY[name](tables.spark, SF))
        facts = [x for x in plan.splitlines() if "FileScan parquet" in x and "part_month#" in x and "date:date" in x]
        assert facts and all(re.search(r"PartitionFilters: \[[^\]]*part_month", x) for x in facts), name


def test_small_campaign_table_leaves_the_fact_where_it_is(tables):
    plan = plan_of(promotions.expand_promotions(tables.sales, tables.promotions))
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    assert "BuildLeft" not in plan, "the campaigns are sent, not the fact"
