"""Published versions, serving from them, intervals and walk-forward errors."""

import datetime as dt
import random

import pytest
from conftest import day, sales_rows
from pyspark.sql import functions as F

from stockpulse.operators import conformal, order_stats
from stockpulse.plans import api, forecast_jobs
from stockpulse.session import scratch_path
from stockpulse.sources.model_store import ModelStore


@pytest.fixture
def store(spark):
    return ModelStore(spark, scratch_path(spark, "test-models"))


def history(spark, n=220):
    a = sales_rows(spark, [20 + i % 7 for i in range(n)])
    b = sales_rows(spark, [10 + i % 3 for i in range(40)], "B", days=range(n - 40, n))
    return a.unionByName(b), day(n - 1)


def test_versions_as_of_and_prune(spark, store):
    for i, upto in enumerate(("2024-01-31", "2024-03-31", "2024-02-29")):
        store.publish("m", upto, {"t": spark.createDataFrame([(i,)], "x int")}, metrics={"i": i})
    assert [v.number for v in store.versions("m")] == [1, 2, 3]
    assert store.get("m").metrics == {"i": 1}  # the newest by what it has seen, not by when it was written
    assert store.get("m", as_of=dt.date(2024, 3, 1)).table("t").first().x == 2
    assert store.get("m", number=1).table("t").first().x == 0
    with pytest.raises(KeyError):
        store.get("m", as_of="2023-12-31")
    with pytest.raises(KeyError):
        store.get("other")
    assert store.prune("m", 1) == 2 and store.numbers("m") == [3] and store.get("m").table("t").count() == 1


def test_half_written_version_is_never_served(spark, store, monkeypatch):
    store.publish("m", "2024-01-31", {"t": spark.createDataFrame([(1,)], "x int")})
    broken = spark.createDataFrame([(1,)], "x int").select((F.col("x") / F.raise_error(F.lit("lost"))).alias("x"))
    with pytest.raises(Exception):
        store.publish("m", "2024-02-29", {"t": spark.createDataFrame([(2,)], "x int"), "u": broken})
    assert store.numbers("m") == [1] and store.get("m").table("t").first().x == 1
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost before the commit")))
    with pytest.raises(OSError):
        store.publish("m", "2024-02-29", {"t": spark.createDataFrame([(2,)], "x int")})
    assert ModelStore(spark, store.root).get("m").table("t").first().x == 1


def test_two_writers_get_two_numbers(spark, store, monkeypatch):
    store.publish("m", "2024-01-31")
    late = ModelStore(spark, store.root)
    answers = iter([[], [1]])
    monkeypatch.setattr(late, "numbers", lambda name: next(answers))  # the other writer's record is seen only at the second look
    assert late.publish("m", "2024-02-29").number == 2
    assert store.numbers("m") == [1, 2]


def test_stored_model_serves_the_same_rows_in_a_new_session(spark, store):
    sales, as_of = history(spark)
    fitted = forecast_jobs.fitted(sales, as_of, 14, maxIter=5, maxDepth=3)
    want = {(r.sku_id, r.date): r.ensemble for r in forecast_jobs.points(*fitted, 14).collect()}
    forecast_jobs.train(sales, as_of, store, horizon=14, maxIter=5, maxDepth=3)
    fresh = ModelStore(spark.newSession(), store.root)
    got = api.serve_forecast(fresh, horizon_days=14).collect()
    assert {(r.sku_id, r.date): r.predicted_demand for r in got} == {k: pytest.approx(round(v, 1), abs=0.11) for k, v in want.items()}
    assert all(r.lower_bound <= r.predicted_demand <= r.upper_bound for r in got if r.lower_bound is not None)
    only = api.serve_forecast(fresh, sku_id="B", horizon_days=7, model="boosted").collect()
    assert len(only) == 7 and {r.sku_id for r in only} == {"B"}
    plan = api.serve_forecast(fresh, sku_id="B", horizon_days=7)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(sku_id), EqualTo(sku_id,B)]" in plan
    record = api.serve_response(fresh, horizon_days=14, model="lookback").filter("sku_id = 'A'").first()
    errors = {r.member: r.mape for r in store.get("forecast").table("errors").filter("sku_id = 'A'").collect()}
    assert record.mape == round(errors["lookback"], 2) and len(record.forecast) == 14
    with pytest.raises(ValueError):
        forecast_jobs.serve(store.publish("closed", as_of, forecast_jobs.fitted(sales, as_of, 7, boosted=False)[0]), 7, "boosted")


def test_backtest_of_every_member(spark):
    sales, as_of = history(spark)
    rows = forecast_jobs.backtest(sales, as_of, 2, 14, maxIter=5, maxDepth=3).collect()
    assert sorted((r.fold, r.member) for r in rows) == sorted((f, m) for f in (1, 2) for m in ("seasonal", "boosted", "lookback", "ensemble"))
    assert all(0 <= r.mape < 60 for r in rows)


def test_order_statistic_is_exact(spark):
    rng = random.Random(1)
    rows = [("a", rng.choice((1.0, 2.0, rng.random()))) for _ in range(5000)] + [("b", float(i)) for i in range(9)] + [("c", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    for share in (0.1, 0.5, 0.9):
        got = {r.g: (r.n, r.q) for r in order_stats.order_statistic(df, ["g"], "v", F.ceil(F.col("n") * share), "q").collect()}
        for g in "abc":
            own = sorted(v for k, v in rows if k == g)
            assert got[g] == (len(own), own[-(-int(len(own) * share * 10) // 10) - 1 if share != 0.5 else -(-len(own) // 2) - 1])


def test_intervals_cover_held_out_days(spark):
    """Calibrated on one month, they hold on the next: series of several sizes with skewed errors."""
    rng = random.Random(3)
    level = {f"S{i}": 5 * (1 + i % 9) for i in range(60)}
    rows = [(s, "R", day(d), float(v * (1 + rng.expovariate(3) - 0.33)), float(v)) for s, v in level.items() for d in range(56)]
    held = spark.createDataFrame(rows, "sku_id string, region string, date date, actual double, seasonal double")
    levels = spark.createDataFrame([(s, "R", float(v)) for s, v in level.items()], "sku_id string, region string, level double")
    first = held.filter(F.col("date") <= F.lit(day(27)))
    widths = conformal.calibrate(first, levels, day(-1), ["seasonal"])
    assert [r.week for r in widths.orderBy("week").collect()] == [0, 1, 2, 3]
    then = held.filter(F.col("date") > F.lit(day(27))).withColumnRenamed("seasonal", "predicted_demand")
    out = conformal.with_intervals(then, widths, levels, day(27), "seasonal")
    share = out.agg(F.avg(F.col("actual").between(F.col("lower_bound"), F.col("upper_bound")).cast("double"))).first()[0]
    assert 0.88 <= share <= 0.93
    none = conformal.with_intervals(then, widths, levels, day(27), "other").first()
    assert none.lower_bound is None and none.upper_bound is None
