"""Checks, loads and writes."""

import datetime as dt

import pytest
from conftest import day, sales_rows
from pyspark.sql import functions as F

from stockpulse.operators import features, kpis, quality
from stockpulse.plans import jobs
from stockpulse.sources import sinks, tables as readers


def test_each_check_fails_once(spark):
    df = spark.createDataFrame([("A", 1, "spike"), ("A", 1, "flat"), (None, 2, None), ("Z", 3, "drop")], "sku string, d int, direction string")
    known = spark.createDataFrame([("A",)], "sku_id string")
    checks = {"key": quality.duplicate_keys(df, ["sku", "d"]), "orphan": quality.orphans(df, known, "sku", "sku_id"),
              "domain": quality.domain_violations(df, F.col("direction").isin("spike", "drop"))}
    report = quality.report(checks)
    assert {r.check_name: r.failures for r in report.collect()} == {"key": 1, "orphan": 1, "domain": 1}
    assert {r.column_name: r.nulls for r in quality.null_counts(df, ["sku", "direction"]).collect()} == {"sku": 1, "direction": 1}
    with pytest.raises(ValueError, match="key: 1"):
        quality.enforce(report)


def test_defaults(spark):
    df = spark.createDataFrame([(None, None)], "sales_qty long, is_holiday boolean")
    assert list(quality.apply_defaults(df, "sku_daily_sales").first()) == [0, False]


def test_insert_if_absent_keeps_the_old_row(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 2), ("b", 2)], "k string, v int")
    assert sorted(map(tuple, sinks.upsert_absent(new, old, ["k"]).collect())) == [("a", 1), ("b", 2)]


def test_update_touches_null_cells_only(spark):
    target = spark.createDataFrame([("a", None), ("b", 5.0), ("c", None)], "k string, m double")
    source = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, x double")
    got = dict(map(tuple, sinks.update_from(target, source, ["k"], "m", F.col("x")).collect()))
    assert got == {"a": 1.0, "b": 5.0, "c": None}


def test_realized_error_uses_the_region(spark):
    sales = sales_rows(spark, [10, 20]).unionByName(sales_rows(spark, [40, 50], region="Q"))
    fc = spark.createDataFrame([("A", "R", day(0), 15.0, None), ("A", "Q", day(0), 15.0, None), ("A", "R", day(1), 15.0, None)],
                               "sku_id string, region string, target_date date, predicted_qty double, realized_mape double")
    got = {(r.region, r.target_date): r.realized_mape for r in sinks.realize_forecasts(fc, sales, day(1)).collect()}
    assert got == {("R", day(0)): 50.0, ("Q", day(0)): 62.5, ("R", day(1)): None}


def test_dedupe_keeps_the_newest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, t int, v string")
    assert sorted(map(tuple, sinks.dedupe_latest(df, ["k"], ["t", "v"]).collect())) == [("a", 3, "y"), ("b", 1, None)]


def test_month_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "fs")
    first = spark.createDataFrame([("A", dt.date(2024, 1, 5), 1), ("A", dt.date(2024, 2, 5), 2)], "sku_id string, date date, v int")
    sinks.overwrite_months(first, path)
    sinks.overwrite_months(first.filter("v = 2").withColumn("v", F.lit(7)), path)
    sinks.overwrite_months(first.filter("v = 2").withColumn("v", F.lit(7)), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 7]


def test_feature_store_count_and_schema(spark, tables, tmp_path):
    path = str(tmp_path / "store")
    n = jobs.run_features(tables, tables.as_of, path)
    stored = spark.read.parquet(path)
    assert stored.count() == n > 0
    assert dict(stored.dtypes)["rolling_mean_7"] == "decimal(12,4)"
    assert set(features.FEATURE_COLUMNS) <= set(stored.columns)


def test_jobs(spark, tables, tmp_path):
    jobs.refresh_views(tables, str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v" / "regional_kpis")).count() > 0
    assert jobs.daily_checks(tables).filter("failures > 0").count() == 0
    assert jobs.ingest_inventory(tables.inventory, tables.as_of, str(tmp_path / "inv")) == {"records_synced": 250}
    kelvin = spark.createDataFrame([("R", day(0), 300.0), ("R", day(1), 290.0)], "region string, date date, temp_kelvin double")
    stored = spark.createDataFrame([("R", day(0), 9.0)], "region string, date date, score double")
    assert [(r.date, r.score) for r in jobs.ingest_weather(kelvin, stored).collect()] == [(day(1), -0.5)]
    assert jobs.check_drift(tables).count() == 1 and jobs.check_accuracy(tables).count() == 1


def test_csv_and_seed_rows(spark, tmp_path):
    readers.seed_regions(spark).write.option("header", True).csv(str(tmp_path / "regions"))
    got = readers.read_table(spark, "regions", {"format": "csv", "path": str(tmp_path)})
    assert got.count() == 5 and got.filter("tier = 2").first()["name"] == "Punjab"
    products = readers.seed_products(spark)
    products.write.parquet(str(tmp_path / "products"))
    assert readers.read_table(spark, "products", {"format": "parquet", "path": str(tmp_path)}).count() == 8
    with pytest.raises(ValueError):
        readers.read_table(spark, "products", {"format": "xml"})
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, "jdbc:postgresql://h/db", "t", partitions=4)


def test_history_of_one_series(spark):
    sales = sales_rows(spark, range(400))
    assert readers.load_sku_history(sales, day(399), "A", "R").count() == 366
    with pytest.raises(KeyError):
        readers.load_sku_history(sales, day(399), "missing", "R")


def test_daily_loads_of_one_month_stay(spark, tmp_path):
    path = str(tmp_path / "inv")
    raw = spark.createDataFrame([("A", "W", day(0), 5), ("A", "W", day(1), 6), ("A", "W", day(1), 6), ("A", "W", day(2), 7)],
                                "sku_id string, warehouse_id string, snapshot_date date, quantity_on_hand int")
    for i in (0, 1, 0, 1):  # two days, then both again
        assert jobs.ingest_inventory(raw, day(i), path) == {"records_synced": 1}
    assert sorted((r.snapshot_date, r.quantity_on_hand) for r in spark.read.parquet(path).collect()) == [(day(0), 5), (day(1), 6)]


def test_second_feature_run_keeps_older_days(spark, tables, tmp_path):
    path = str(tmp_path / "store")
    jobs.run_features(tables, tables.as_of - dt.timedelta(days=20), path)
    before = {tuple(r) for r in spark.read.parquet(path).collect()}
    jobs.run_features(tables, tables.as_of, path)
    assert before <= {tuple(r) for r in spark.read.parquet(path).collect()}
    with pytest.raises(ValueError):
        jobs.run_features(tables, tables.as_of, path, lookback=100)


def test_refresh_drops_months_that_left(spark, tables, tmp_path):
    path = str(tmp_path / "v")
    daily = kpis.sku_daily_kpis(tables.sales, tables.forecasts, tables.inventory)
    sinks.refresh_views(daily, kpis.regional_daily_kpis, path)
    recent = daily.filter(F.col("date") > F.date_sub(F.lit(tables.as_of), 40))
    sinks.refresh_views(recent, kpis.regional_daily_kpis, path)
    assert spark.read.parquet(f"{path}/sku_daily_kpis").count() == recent.count()
    assert spark.read.parquet(f"{path}/regional_kpis").agg(F.min("date")).first()[0] > tables.as_of - dt.timedelta(days=40)
