"""Alerts against a baseline that the stream itself keeps, one state per series.

The state of a series is the count, mean and sum of squared deviations of its finished days, and the totals of its
days that may still grow. When the watermark passes the end of a day, an event-time timer fires: the day is scored
against the days before it, then merged into the baseline (Chan's pairwise update, so baselines can be merged).
A series without events for ``IDLE_DAYS`` of event time gives its state back.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .aggregates import ALERT_SCORE

# Executors need not have this package installed: the processor travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

IDLE_DAYS, LEAST_DAYS = 400, 7
DAY_MS = 86_400_000
OUTPUT = "sku_id string, region string, date date, actual_value double, mean_qty double, std_qty double, anomaly_score double"
#: The provider that keeps timers and lists of state; set on the session before the query starts.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merged(a: tuple[int, float, float], b: tuple[int, float, float]) -> tuple[int, float, float]:
    """(n, mean, sum of squared deviations) of two disjoint samples together."""
    n = a[0] + b[0]
    if not n:
        return a
    gap = b[1] - a[1]
    return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n


def surprise(value: float, baseline: tuple[int, float, float]) -> float:
    """1 - exp(-z^2/2) of the value; 0 without a deviation."""
    n, mean, m2 = baseline
    std = math.sqrt(m2 / (n - 1)) if n > 1 else 0.0
    return 1 - math.exp(-((value - mean) / std) ** 2 / 2) if std > 0 else 0.0


class SeriesBaseline(StatefulProcessor):
    """Scores and learns the finished days of one series."""

    def __init__(self, threshold: float = ALERT_SCORE, least_days: int = LEAST_DAYS, idle_days: int = IDLE_DAYS):
        self.threshold, self.least_days, self.idle_days = threshold, least_days, idle_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.baseline = handle.getValueState("baseline", "n long, mean double, m2 double, last_day long")
        self.days = handle.getMapState("days", "day long", "qty long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        totals: dict[int, int] = {}
        for part in rows:
            day = part["ts"].astype("datetime64[us]").astype("int64") // (DAY_MS * 1000)
            for d, q in part["qty"].groupby(day).sum().items():
                totals[int(d)] = totals.get(int(d), 0) + int(q)
        for d, q in totals.items():
            held = self.days.getValue((d,))[0] if self.days.containsKey((d,)) else 0
            self.days.updateValue((d,), (held + q,))
            self.handle.registerTimer((d + 1) * DAY_MS)
        if totals:
            self.handle.registerTimer((max(totals) + self.idle_days) * DAY_MS)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        done = sorted((k[0], v[0]) for k, v in self.days.iterator() if (k[0] + 1) * DAY_MS <= at)
        n, mean, m2, last = self.baseline.get() if self.baseline.exists() else (0, 0.0, 0.0, -1)
        alerts = []
        for day, qty in done:
            score = surprise(qty, (n, mean, m2)) if n >= self.least_days else 0.0
            if score > self.threshold:
                alerts.append((*key, dt.date(1970, 1, 1) + dt.timedelta(days=day), float(qty), mean, math.sqrt(m2 / (n - 1)), score))
            n, mean, m2 = merged((n, mean, m2), (1, float(qty), 0.0))
            last = max(last, day)
            self.days.removeKey((day,))
        if done:
            self.baseline.update((n, mean, m2, last))
        elif last >= 0 and (last + self.idle_days) * DAY_MS <= at and not any(True for _ in self.days.keys()):
            self.baseline.clear()
        if alerts:
            yield pd.DataFrame(alerts, columns=["sku_id", "region", "date", "actual_value", "mean_qty", "std_qty", "anomaly_score"])

    def close(self) -> None:
        pass


def stateful_alerts(events: DataFrame, threshold: float = ALERT_SCORE, least_days: int = LEAST_DAYS, idle_days: int = IDLE_DAYS) -> DataFrame:
    """Alerts of finished days of de-duplicated, watermarked events (sku_id, region, qty, ts)."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return events.select("sku_id", "region", "qty", "ts").groupBy("sku_id", "region").transformWithStateInPandas(
        SeriesBaseline(threshold, least_days, idle_days), OUTPUT, "append", "eventTime")
