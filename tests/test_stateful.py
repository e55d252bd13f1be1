"""Alerts from state: replays, late rows, restarts, and equality with a batch window."""

import math

import pytest
from test_streaming import Topic, payload

from stockpulse.session import scratch_path
from stockpulse.streaming import events, sinks, stateful


def test_merged_baselines_equal_one_pass():
    values = [3.0, 8.0, 1.5, 9.0, 4.0, 4.0]
    one = (0, 0.0, 0.0)
    for v in values:
        one = stateful.merged(one, (1, v, 0.0))
    half = [(0, 0.0, 0.0), (0, 0.0, 0.0)]
    for i, v in enumerate(values):
        half[i % 2] = stateful.merged(half[i % 2], (1, v, 0.0))
    both = stateful.merged(*half)
    mean = sum(values) / len(values)
    want = (len(values), mean, sum((v - mean) ** 2 for v in values))
    assert one == pytest.approx(want) and both == pytest.approx(want) and stateful.merged((0, 0.0, 0.0), (0, 0.0, 0.0))[0] == 0
    assert stateful.surprise(5.0, (1, 5.0, 0.0)) == 0.0


def expected(days, least):
    """Alerts by a plain look at all days before each."""
    out = {}
    for i, (d, q) in enumerate(days):
        past = [x for _, x in days[:i]]
        if len(past) >= least:
            mean = sum(past) / len(past)
            std = math.sqrt(sum((x - mean) ** 2 for x in past) / (len(past) - 1))
            score = 1 - math.exp(-((q - mean) / std) ** 2 / 2) if std else 0.0
            if score > 0.9:
                out[d] = round(score, 9)
    return out


class Alerts:
    def __init__(self, spark, tmp_path):
        self.topic, self.spark = Topic(spark, tmp_path), spark
        self.base = scratch_path(spark, "test-alerts")

    def run(self):
        good, _ = events.parse_events(self.topic.stream(), "sales-events")
        stream = stateful.stateful_alerts(events.deduplicated(good), least_days=3)
        sinks.append_table(stream, f"{self.base}/data", f"{self.base}/checkpoint").awaitTermination()
        rows = self.spark.read.schema(stateful.OUTPUT).parquet(f"{self.base}/data").collect()
        assert len({(r.sku_id, r.date) for r in rows}) == len(rows)  # no day is alerted twice
        return {(r.date.toordinal() - 738886): round(r.anomaly_score, 9) for r in rows}


def test_replay_late_rows_and_restart(spark, tmp_path):
    a = Alerts(spark, tmp_path)
    quantities = [10, 12, 9, 11, 40, 10, 9, 12, 60, 11]
    for d in range(6):
        a.topic.add([payload(d, 24 * d, quantities[d])])
    a.topic.add([payload(4, 24 * 4, quantities[4]), payload(5, 24 * 5, quantities[5])])  # replayed
    a.run()
    a.topic.add([payload(105, 24 * 5 + 6, 2)])               # the same day, a little late: still counted
    quantities[5] += 2
    for d in range(6, 10):                                    # a restart: state comes from the checkpoint
        a.topic.add([payload(d, 24 * d, quantities[d])])
    a.topic.add([payload(900, 24 * 2, 500)])                  # a week late: dropped
    a.topic.add([payload(999, 24 * 30, 1)])                   # closes the days before
    got = a.run()
    want = expected(list(enumerate(quantities)), 3)
    assert set(want) == {4, 8} and got == want


def test_idle_series_gives_its_state_back(spark, tmp_path):
    a = Alerts(spark, tmp_path)
    good, _ = events.parse_events(a.topic.stream(), "sales-events")
    for d, q in enumerate([10, 12, 9, 11, 10]):
        a.topic.add([payload(d, 24 * d, q)])
    a.topic.add([payload(50, 24 * 40, 1, "Z")])
    a.topic.add([payload(51, 24 * 41, 1, "Z")])
    a.topic.add([payload(52, 24 * 60, 90), payload(53, 24 * 80, 1, "Z")])
    a.topic.add([payload(54, 24 * 85, 1, "Z")])
    stream = stateful.stateful_alerts(events.deduplicated(good), least_days=3, idle_days=10)
    sinks.append_table(stream, f"{a.base}/data", f"{a.base}/checkpoint").awaitTermination()
    assert spark.read.schema(stateful.OUTPUT).parquet(f"{a.base}/data").count() == 0  # A's old days no longer count
