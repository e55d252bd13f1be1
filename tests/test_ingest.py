"""Feeds taken exactly once, refused rows, and views that follow the days of a load."""

import os

import pytest
from conftest import SF, day, plan_of
from pyspark.sql import functions as F

from stockpulse.operators import kpis
from stockpulse.plans import incremental
from stockpulse.session import scratch_path
from stockpulse.sources import ingest, sinks

HEADER = "line_id,sku_id,region,date,sales_qty,revenue_inr,returns_qty\n"


def drop(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(HEADER + "".join(f"{line}\n" for line in lines))


def test_crash_between_write_and_commit_takes_no_row_twice(spark, tmp_path):
    feed, target = str(tmp_path / "feed"), str(tmp_path / "target")
    drop(feed, "a.csv", "1,A,R,2024-01-01,5,10.0,0", "2,A,R,2024-01-01,3,6.0,0")

    def die(number):
        raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        ingest.ingest(spark, ingest.POS, feed, target, before_commit=die)
    assert ingest.committed(spark, target) == [] and ingest.read_feed(spark, ingest.POS, target).count() == 0
    drop(feed, "b.csv", "3,B,R,2024-01-02,1,1.0,0")
    done = ingest.ingest(spark, ingest.POS, feed, target)
    assert done["rows"] == 3 and {r.line_id: r.sales_qty for r in ingest.read_feed(spark, ingest.POS, target).collect()} == {"1": 5, "2": 3, "3": 1}
    assert ingest.ingest(spark, ingest.POS, feed, target) == {"batches": 0, "rows": 0, "refused": 0}


def test_bad_rows_are_set_aside_with_their_reason(spark, tmp_path):
    feed, target = str(tmp_path / "feed"), str(tmp_path / "target")
    drop(feed, "a.csv", "1,A,R,2024-01-01,5,10.0,0", "2,A,R,2024-01-01,-3,6.0,0", "3,A,R,yesterday,3,6.0,0", "4,,R,2024-01-01,3,6.0,0",
         "5,A,R,2024-01-01,,6.0,0", "1,A,R,2024-01-01,5,10.0,0")
    done = ingest.ingest(spark, ingest.POS, feed, target)
    assert done == {"batches": 1, "rows": 1, "refused": 4}  # the repeated line counts once
    refused = {(r.reason, r.line is not None) for r in ingest.read_refused(spark, target).collect()}
    assert refused == {("sales_qty", False), ("unreadable", True), ("sku_id", False)}
    assert all(r.file.endswith("a.csv") for r in ingest.read_refused(spark, target).collect())


def test_a_row_delivered_again_counts_as_last_delivered(spark, tmp_path):
    feed, target = str(tmp_path / "feed"), str(tmp_path / "target")
    drop(feed, "a.csv", "1,A,R,2024-01-01,5,10.0,0")
    ingest.ingest(spark, ingest.POS, feed, target)
    drop(feed, "b.csv", "1,A,R,2024-01-03,7,10.0,0")
    ingest.ingest(spark, ingest.POS, feed, target)
    assert [(r.date, r.sales_qty) for r in ingest.read_feed(spark, ingest.POS, target).collect()] == [(day(2, "2024-01-01"), 7)]
    days = {str(r.date) for r in ingest.touched_days(spark, ingest.POS, target, after=0).collect()}
    assert days == {"2024-01-01", "2024-01-03"}  # the day it left counts as touched


def test_empty_folder(spark, tmp_path):
    os.makedirs(tmp_path / "feed")
    assert ingest.ingest(spark, ingest.COMPETITOR, str(tmp_path / "feed"), str(tmp_path / "t"), kind="json")["batches"] == 0
    assert ingest.read_feed(spark, ingest.COMPETITOR, str(tmp_path / "t")).count() == 0 and ingest.read_refused(spark, str(tmp_path / "t")).count() == 0


def times(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_views_follow_touched_days_only(spark, tables):
    path, sales = scratch_path(spark, "test-views"), tables.sales
    sales = sales.filter(F.col("date") >= "2000-01-01")
    late = F.col("date").isin(*[d.date for d in sales.select("date").distinct().orderBy("date").limit(40).collect()[33:36]])
    state = {"sales": sales.filter(~late)}

    def sources(days):
        pick = lambda df, c: df.join(days.select(F.col("date").alias(c)), c, "left_semi")
        return pick(state["sales"], "date"), pick(tables.forecasts, "target_date"), pick(tables.inventory, "snapshot_date")

    def check():
        got = incremental.regional_view(spark, path)
        want = kpis.regional_daily_kpis(kpis.sku_daily_kpis(state["sales"], tables.forecasts, tables.inventory))
        text = lambda df: sorted(str([r[c] if not isinstance(r[c], float) else round(r[c], 6) for c in sorted(want.columns)]) for r in df.collect())
        assert text(got) == text(want)

    incremental.record_load(state["sales"].select("date"), path, 0)
    assert incremental.refresh(spark, path, sources) and incremental.refresh(spark, path, sources) == []
    check()
    before = times(path)
    state["sales"] = sales
    incremental.record_load(sales.filter(late).select("date"), path, 1)
    months = {f"{d:%Y-%m}" for d in incremental.refresh(spark, path, sources)}
    check()
    after = times(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert all(any(m in f for m in months) for f in before if f not in same and "part_month" in f) and len(same) > len(before) / 2
    # a day whose rows are all taken back, and a refresh that dies before it is marked as done
    gone = sales.agg(F.max("date")).first()[0]
    state["sales"] = sales.filter(F.col("date") < F.lit(gone))
    incremental.record_load(spark.createDataFrame([(gone,)], "date date"), path, 2)
    with pytest.raises(OSError):
        incremental.refresh(spark, path, lambda days: (_ for _ in ()).throw(OSError("lost")))
    assert incremental.pending(spark, path) == [2] and incremental.refresh(spark, path, sources) == [gone]
    check()


def test_unused_columns_and_copies_of_the_row_are_not_shuffled(spark, tmp_path):
    feed, target = str(tmp_path / "feed"), str(tmp_path / "target")
    drop(feed, "a.csv", "1,A,R,2024-01-01,5,10.0,0", "1,A,R,2024-01-02,6,10.0,0", "2,B,R,2024-01-01,4,10.0,1", "2,B,R,2024-01-01,4,10.0,1", ",C,R,2024-01-01,1,1.0,0", ",C,S,2024-01-01,1,1.0,0")
    assert ingest.ingest(spark, ingest.POS, feed, target)["rows"] == 3  # keys 1, 2 and null
    sums = ingest.read_feed(spark, ingest.POS, target).groupBy("date").agg(F.sum("sales_qty").alias("sales_qty"))
    assert {str(r.date): r.sales_qty for r in sums.collect()} == {"2024-01-01": 5, "2024-01-02": 6}
    moved = [x for x in plan_of(sums).splitlines() if "max_by" in x]
    assert moved and not any("region" in x or "revenue_inr" in x for x in moved)
    latest = sinks.dedupe_latest(spark.range(3).select(F.lit(1).alias("k"), "id"), ["k"], ["id"])
    assert latest.first().id == 2 and "max_by" not in plan_of(latest)
