"""Stream sinks: append to a table, and an idempotent upsert log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path
from .aggregates import latest_stock


def append_table(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append finished rows to Parquet; the checkpoint makes a restart continue without loss or repeats."""
    return (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())


def drain(stream: DataFrame, label: str, close: Callable[[], None] | None = None) -> DataFrame:
    """Run a stream over everything available and return what it appended.

    ``close`` adds the event that ends the input; the stream goes on from its checkpoint and emits the
    windows that were still open.
    """
    base = scratch_path(stream.sparkSession, label)
    append_table(stream, f"{base}/data", f"{base}/checkpoint").awaitTermination()
    if close:
        close()
        append_table(stream, f"{base}/data", f"{base}/checkpoint").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/data")


def stock_log(updates: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Newest quantity per key of every micro-batch, written to a folder named after the batch.

    A replayed batch overwrites its own folder, so the log is idempotent, and a batch costs its own
    size, not a rewrite of the whole stock table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        latest_stock(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (updates.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())


def current_stock(spark: SparkSession, path: str) -> DataFrame:
    """State of the upsert log: the newest entry of each key over all batches."""
    return latest_stock(spark.read.option("basePath", path).parquet(path).drop("batch_id"))


def compact_stock(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Write the current state as a new log that starts with one batch."""
    current_stock(spark, path).write.parquet(f"{target}/batch_id=-1")
    return spark.read.parquet(target).drop("batch_id")


def publish_alerts(alerts: DataFrame, checkpoint: str, source: dict) -> StreamingQuery:
    """Alerts as JSON to the Kafka topic, or as text files to a folder."""
    payload = alerts.select(F.to_json(F.struct(*alerts.columns)).alias("value"))
    writer = payload.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if source["format"] == "kafka":
        options = {k: v for k, v in source.items() if k != "format"}
        writer = writer.format("kafka").option("topic", "anomaly-alerts").options(**options)
    else:
        writer = writer.format("text").option("path", source["path"])
    return writer.trigger(availableNow=True).start()
