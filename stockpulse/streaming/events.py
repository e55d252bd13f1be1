"""Event streams: reading topics, parsing payloads, removing replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..schemas import EVENT_SCHEMAS

#: Topics and their partition counts.
TOPIC_PARTITIONS = {"sales-events": 5, "inventory-updates": 3, "forecast-events": 3, "anomaly-alerts": 2, "promotions": 2}
#: Ours: events may arrive one day late.
LATENESS = "1 day"
CLICK_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def read_topic(spark: SparkSession, topic: str, source: dict) -> DataFrame:
    """Raw stream with a text ``value`` column from Kafka or from a folder of JSON lines."""
    if source["format"] == "kafka":
        options = {k: v for k, v in source.items() if k != "format"}
        raw = spark.readStream.format("kafka").option("subscribe", topic).options(**options).load()
        return raw.select(F.col("value").cast("string").alias("value"))
    if source["format"] == "text":
        reader = spark.readStream.format("text")
        if "max_files" in source:
            reader = reader.option("maxFilesPerTrigger", source["max_files"])
        return reader.load(source["path"])
    raise ValueError(f"unknown stream format {source['format']!r}")


def parse_events(raw: DataFrame, topic: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows): a payload that is no valid event never fails the query."""
    parsed = raw.withColumn("event", fx.from_event_json("value", EVENT_SCHEMAS[topic]))
    first = EVENT_SCHEMAS[topic].split()[0]
    good = F.col("event").isNotNull() & F.col(f"event.{first}").isNotNull()
    return parsed.filter(good).select("event.*"), parsed.filter(~F.coalesce(good, F.lit(False))).select("value")


def sales_from_clicks(clicks: DataFrame, regions: DataFrame) -> DataFrame:
    """Purchases of the click table as sales events; works on streams and on batches."""
    k = F.get_json_object("props", "$.k").cast("long")
    return (
        clicks.filter(F.col("event_type") == "purchase")
        .select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 5).alias("rk"),
                F.concat(F.lit("Brand#"), (1 + k % 25).cast("string")).alias("sku_id"), (1 + k % 9).alias("qty"),
                F.col("value").alias("amount"))
        .join(regions.select(F.col("r_regionkey").cast("long").alias("rk"), "region"), "rk")
        .select("event_id", "sku_id", "region", "qty", "amount", "ts")
    )


def read_clicks(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CLICK_SCHEMA).parquet(path)


def with_closing(clicks: DataFrame, folder: str) -> DataFrame:
    """The click stream and whatever is put into ``folder``: a place for the event that closes its windows."""
    spark = clicks.sparkSession
    spark.createDataFrame([], CLICK_SCHEMA).write.mode("append").parquet(folder)
    return clicks.unionByName(spark.readStream.schema(CLICK_SCHEMA).parquet(folder))


def close_clicks(clicks: DataFrame, folder: str, days: int = 30) -> None:
    """Put one purchase ``days`` after the last of ``clicks`` (a batch) into ``folder``.

    Event time then passes the end of every window of the data; the window of this event stays open.
    """
    last = clicks.agg(F.max("ts").alias("last"))
    row = last.select(F.lit(-1).cast("long").alias("event_id"), F.expr(f"last + INTERVAL '{days}' DAY").cast("timestamp_ntz").alias("ts"),
                      F.lit(0).cast("long").alias("user_id"), F.lit("purchase").alias("event_type"), F.lit(0.0).alias("value"), F.lit('{"k": 0}').alias("props"))
    row.write.mode("append").parquet(folder)


def deduplicated(events: DataFrame, keys=("event_id",), delay: str = LATENESS) -> DataFrame:
    """Replayed events removed; state is dropped once the watermark has passed an event."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))
