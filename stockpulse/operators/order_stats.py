"""Exact order statistics of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def ranked_values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``df`` (``keys`` without nulls) with ``rank`` from 1 in its group by ``value`` and ``n``, the rows of the group.

    Rows are dealt by ranges of (keys, value) and written with their place; one count a range and group tells
    where the range starts, so no task sorts a group of all rows. Ties keep the order of the write.
    """
    dealt = df.withColumn("_spread", F.monotonically_increasing_id())  # many equal values need not share a range
    order = [*keys, value, "_spread"]
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    dealt = stage(dealt.withColumn("_range", F.shiftright("_place", 33)).drop("_spread"), "ranked-values")
    runs = dealt.groupBy("_range", *keys).agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    group = Window.partitionBy(*keys)
    runs = runs.withColumn("_start", F.sum("_rows").over(group.orderBy("_range")) - F.col("_rows")).withColumn("n", F.sum("_rows").over(group))
    joined = dealt.join(runs.drop("_rows"), ["_range", *keys])
    return joined.withColumn("rank", F.col("_start") + F.col("_place") - F.col("_first") + 1).select(*df.columns, "rank", "n")


def order_statistic(df: DataFrame, keys: list[str], value: str, place: Column, name: str) -> DataFrame:
    """keys, n and the value at rank ``place``, an expression of n; groups whose place is beyond n have none."""
    return ranked_values(df, keys, value).filter(F.col("rank") == place).select(*keys, "n", F.col(value).alias(name))
