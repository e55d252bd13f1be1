"""Dyadic covers against the days they stand for, and the join against a nested loop."""

import datetime as dt
import random
from decimal import Decimal

from conftest import day, sales_rows
from pyspark.sql import functions as F

from stockpulse import schemas
from stockpulse.operators import intervals, promotions

EPOCH = dt.date(1970, 1, 1)


def spans(spark, bounds):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(bounds)], "id int, first date, last date")


def test_cover_holds_each_day_once(spark):
    rng = random.Random(5)
    bounds = [(EPOCH + dt.timedelta(a), EPOCH + dt.timedelta(a + n)) for a, n in
              [(0, 0), (-1, 0), (-1, 1), (-7, 20), (8, 7), (1, 0), (9000, 511)] + [(rng.randint(-3000, 20000), rng.randint(0, 3000)) for _ in range(150)]]
    rows = spans(spark, bounds).select("id", intervals.cover("first", "last").alias("c")).collect()
    for r in rows:
        first, last = ((d - EPOCH).days for d in bounds[r.id])
        held = sorted(x for b in r.c for x in range(b.block << b.level, (b.block + 1) << b.level))
        assert held == list(range(first, last + 1))
        assert len(r.c) <= 2 * (last - first + 1).bit_length()


def test_empty_null_and_endless_intervals(spark):
    end = dt.date(9999, 12, 31)
    rows = [r.n for r in spans(spark, [(day(3), day(2)), (None, day(1)), (day(1), None), (dt.date(1, 1, 1), end), (day(0), end)])
            .select("id", F.size(intervals.cover("first", "last")).alias("n")).orderBy("id").collect()]
    assert rows[:3] == [0, 0, 0] and 0 < rows[3] <= 2 * intervals.LEVELS and 0 < rows[4] <= 2 * intervals.LEVELS


def test_join_equals_nested_loop(spark):
    rng = random.Random(6)
    bounds = [(day(rng.randint(-40, 400)), day(rng.randint(-40, 800))) for _ in range(60)] + [(day(5), dt.date(9999, 12, 31)), (None, day(9))]
    facts = [(k, day(rng.randint(-60, 500)) if rng.random() < 0.95 else None) for k in range(400)]
    want = sorted((k, i) for k, d in facts for i, (a, b) in enumerate(bounds) if d and a and b and a <= d <= b)
    blocks = intervals.with_blocks(spans(spark, bounds), "first", "last")
    got = intervals.days_in(spark.createDataFrame(facts, "k int, date date"), blocks).select("k", "id").collect()
    assert sorted((r.k, r.id) for r in got) == want
    nothing = intervals.days_in(spark.createDataFrame(facts, "k int, date date"), blocks.filter("id < 0"))
    assert nothing.columns == ["k", "date", "id", "first", "last"] and nothing.count() == 0


def test_long_campaigns_are_few_rows(spark):
    """Overlapping and endless campaigns give the rows of a nested loop; their blocks do not grow with their days."""
    end, none = dt.date(9999, 12, 31), None
    promos = [("P1", "n", "discount", Decimal("5.00"), day(2), end, ["A"], none), ("P2", "n", "bogo", none, day(0), day(6), ["A", "B"], ["R"]),
              ("P3", "n", "bogo", none, day(4), end, none, ["R"]), ("P4", "n", "bogo", none, dt.date(1990, 1, 1), end, none, none)]
    table = spark.createDataFrame(promos, schemas.PROMOTIONS)
    sales = sales_rows(spark, range(12), "A").unionByName(sales_rows(spark, range(12), "C"))
    got = sorted((r.promo_id, r.sku_id, r.date, r.phase) for r in promotions.expand_promotions(sales, table, 2, 1).collect())
    want = sorted((p[0], s, day(i), "before" if day(i) < p[4] else "after" if day(i) > p[5] else "during") for p in promos for s in "AC" for i in range(12)
                  if p[4] - dt.timedelta(2) <= day(i) and (p[5] == end or day(i) <= p[5] + dt.timedelta(1)) and (p[6] is None or s in p[6]) and (p[7] is None or "R" in p[7]))
    assert got == want
    blocks = intervals.with_blocks(promotions.promo_windows(table), "window_start", "window_end")
    assert blocks.groupBy("promo_id").count().agg(F.max("count")).first()[0] <= 2 * intervals.LEVELS
