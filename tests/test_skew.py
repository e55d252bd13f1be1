"""A third of all order lines on one part, one order and one customer; replays in bulk."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockpulse.sources import retail, sinks
from stockpulse.streaming import aggregates

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skewed"))
    hot = F.col("id") % 3 == 0
    lines = spark.range(N).select(
        F.when(hot, 7).otherwise(F.col("id") % 500).alias("l_orderkey"), F.when(hot, 3).otherwise(F.col("id") % 40).alias("l_partkey"),
        F.lit(1).cast("long").alias("l_suppkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"), (F.col("id") % 1000 * 1.25).alias("l_extendedprice"),
        (F.col("id") % 11 / 100).alias("l_discount"), (F.col("id") % 9 / 100).alias("l_tax"),
        F.when(F.col("id") % 5 == 0, "R").otherwise("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.expr("cast(date_add(date'2020-01-01', cast(id % 60 as int)) as timestamp_ntz)").alias("l_shipdate"))
    lines.repartition(6).write.parquet(f"{root}/lineitem.parquet")
    spark.range(500).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20).alias("o_custkey")).write.parquet(f"{root}/orders.parquet")
    spark.range(20).select(F.col("id").alias("c_custkey"), (F.col("id") % 4).cast("int").alias("c_nationkey")).write.parquet(f"{root}/customer.parquet")
    spark.range(4).select(F.col("id").cast("int").alias("n_nationkey"), (F.col("id") % 2).cast("int").alias("n_regionkey")).write.parquet(f"{root}/nation.parquet")
    spark.range(2).select(F.col("id").cast("int").alias("r_regionkey"), F.concat(F.lit("R"), "id").alias("r_name")).write.parquet(f"{root}/region.parquet")
    spark.range(40).select(F.col("id").alias("p_partkey"), F.concat(F.lit("part "), "id").alias("p_name"),
                           F.concat(F.lit("Brand#"), F.col("id") % 5 + 1).alias("p_brand"), F.lit("T").alias("p_type"),
                           F.lit(1).alias("p_size"), (F.col("id") + 900.0).alias("p_retailprice")).write.parquet(f"{root}/part.parquet")
    return root


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_hot_keys_keep_every_row(spark, skewed, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        ours = retail.daily_sales(spark, skewed).toPandas()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    read = lambda n: spark.read.parquet(f"{skewed}/{n}.parquet").toPandas()
    wide = (read("lineitem").merge(read("part"), left_on="l_partkey", right_on="p_partkey").merge(read("orders"), left_on="l_orderkey", right_on="o_orderkey")
            .merge(read("customer"), left_on="o_custkey", right_on="c_custkey").merge(read("nation"), left_on="c_nationkey", right_on="n_nationkey")
            .merge(read("region"), left_on="n_regionkey", right_on="r_regionkey"))
    assert len(wide) == N
    expected = wide.groupby(["p_brand", "r_name", wide.l_shipdate.dt.date]).l_quantity.sum()
    got = ours.set_index(["sku_id", "region", "date"]).sales_qty
    assert len(got) == len(expected) and got.sum() == wide.l_quantity.sum()
    assert (got.sort_index().to_numpy() == expected.sort_index().to_numpy()).all()


def test_many_copies_of_one_key(spark):
    rows = spark.range(N).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    kept = sinks.dedupe_latest(rows.repartition(8), ["k"], ["t"])
    pdf = rows.toPandas().groupby("k").t.max()
    got = kept.toPandas().set_index("k").t
    assert isinstance(got, pd.Series) and (got.sort_index() == pdf.sort_index()).all()
    assert sinks.append_absent(rows, spark.range(0).select(F.col("id").alias("k")), ["k"]).count() == len(pdf)


def test_latest_stock_of_a_hot_key(spark):
    rows = spark.range(N).select(F.lit("A").alias("sku_id"), F.lit("W").alias("warehouse_id"), F.timestamp_seconds("id").alias("ts"),
                                 (F.col("id") % 100).cast("int").alias("quantity_on_hand"))
    r = aggregates.latest_stock(rows).collect()
    assert len(r) == 1 and r[0].quantity_on_hand == (N - 1) % 100
