"""Replays, late rows, restarts, broken payloads, alerts and the upsert log."""

import datetime as dt
import json

import pytest
from conftest import SF
from pyspark.sql import functions as F

from stockpulse.session import scratch_path
from stockpulse.sources import retail
from stockpulse.streaming import aggregates, events, sinks

T0 = dt.datetime(2024, 1, 1, 12)


def payload(i, hours, qty=1, sku="A", region="R"):
    ts = (T0 + dt.timedelta(hours=hours)).isoformat() + "Z"
    return json.dumps({"event_id": i, "sku_id": sku, "region": region, "qty": qty, "amount": qty * 2.0, "ts": ts})


class Topic:
    """A folder of JSON-lines files, read one file per micro-batch in the order they were added."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path, self.n = spark, tmp_path / "topic", 0
        self.path.mkdir()
        self.base = scratch_path(spark, "test_topic")

    def add(self, lines):
        import os

        target = self.path / f"{self.n:03d}.json"
        target.write_text("\n".join(lines) + "\n")
        os.utime(target, (1_700_000_000 + self.n * 10,) * 2)
        self.n += 1

    def stream(self):
        return events.read_topic(self.spark, "sales-events", {"format": "text", "path": str(self.path), "max_files": 1})

    def days(self):
        good, _ = events.parse_events(self.stream(), "sales-events")
        return aggregates.flat_days(aggregates.daily_sales(events.deduplicated(good)))

    def run(self):
        query = sinks.append_table(self.days(), f"{self.base}/data", f"{self.base}/checkpoint")
        query.awaitTermination()
        return query, {r.date.isoformat(): r.sales_qty for r in self.spark.read.parquet(f"{self.base}/data").collect()}


def test_replays_late_rows_and_restart(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.add([payload(1, 0), payload(2, 1, 2)])
    topic.add([payload(3, 24, 5), payload(1, 0)])
    topic.add([payload(3, 24, 5), payload(4, 26)])
    _, first = topic.run()
    topic.add([payload(5, 20, 7)])                      # six hours behind: still counted
    topic.add([payload(6, 24 * 6, 1)])                  # moves the watermark on
    topic.add([payload(7, 2, 100)])                     # days behind: dropped
    topic.add([payload(8, 24 * 12, 1)])
    query, second = topic.run()
    assert second["2024-01-01"] == 3 and second["2024-01-02"] == 5 + 1 + 7 and second["2024-01-07"] == 1
    assert set(first) <= set(second) and "2024-01-13" not in second
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in json.loads(p.json)["stateOperators"])
    assert dropped >= 1


def test_broken_payloads_are_routed_out(spark, tmp_path):
    raw = spark.createDataFrame([(payload(1, 0),), ("not json",), ('{"sku_id": "A"}',), (None,)], "value string")
    good, bad = events.parse_events(raw, "sales-events")
    assert good.count() == 1 and sorted(str(r.value) for r in bad.collect()) == ["None", "not json", '{"sku_id": "A"}']


def test_stream_equals_batch(spark):
    regions = retail.region_names(spark, SF)
    batch = events.sales_from_clicks(spark.read.parquet(f"{SF}/events.parquet"), regions)
    expected = {(r.sku_id, r.region, r.date): r.sales_qty for r in aggregates.flat_days(aggregates.daily_sales(batch)).collect()}
    clicks = events.read_clicks(spark, f"{SF}/events*.parquet")
    got = sinks.drain(aggregates.flat_days(aggregates.daily_sales(events.deduplicated(events.sales_from_clicks(clicks, regions)))), "t").collect()
    assert got and all(expected[(r.sku_id, r.region, r.date)] == r.sales_qty for r in got)


def test_spike_alert(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.add([payload(i, 24 * i, 10 if i != 5 else 100) for i in range(9)])
    history = spark.createDataFrame([("A", "R", 10.0, 2.0)], "sku_id string, region string, mean_qty double, std_qty double")
    out = str(tmp_path / "alerts")
    sinks.publish_alerts(aggregates.alerts(topic.days(), history), str(tmp_path / "cp"), {"format": "text", "path": out}).awaitTermination()
    sent = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert [(a["date"], a["actual_value"]) for a in sent] == [("2024-01-06", 100.0)] and sent[0]["anomaly_score"] > 0.9


def test_surprise_is_bounded(spark):
    df = spark.createDataFrame([(10.0, 10.0, 2.0), (1e6, 10.0, 2.0), (5.0, 1.0, 0.0), (5.0, 1.0, None)], "x double, m double, s double")
    assert [round(r[0], 6) for r in df.select(aggregates.surprise(F.col("x"), F.col("m"), F.col("s"))).collect()] == [0.0, 1.0, 0.0, 0.0]


def test_stock_log_is_idempotent(spark, tmp_path):
    schema = "sku_id string, warehouse_id string, region string, quantity_on_hand int, ts timestamp"
    feed = str(tmp_path / "feed")
    rows = [("A", "W", "R", 5, T0), ("A", "W", "R", 3, T0 + dt.timedelta(hours=1)), ("B", "W", "R", 9, T0)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(feed)
    log = scratch_path(spark, "test_log")
    run = lambda: sinks.stock_log(spark.readStream.schema(schema).parquet(feed), f"{log}/d", f"{log}/c").awaitTermination()
    state = lambda: sorted((r.sku_id, r.quantity_on_hand) for r in sinks.current_stock(spark, f"{log}/d").collect())
    run()
    assert state() == [("A", 3), ("B", 9)]
    aggregates.latest_stock(spark.createDataFrame(rows, schema)).write.mode("overwrite").parquet(f"{log}/d/batch_id=0")
    assert state() == [("A", 3), ("B", 9)]
    spark.createDataFrame([("A", "W", "R", 1, T0 + dt.timedelta(hours=2))], schema).write.mode("append").parquet(feed)
    run()
    assert state() == [("A", 1), ("B", 9)]
    assert sinks.compact_stock(spark, f"{log}/d", f"{log}/compact").count() == 2


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        events.read_topic(spark, "sales-events", {"format": "other"})
