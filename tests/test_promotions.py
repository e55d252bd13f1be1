"""Campaign expansion against a nested loop, and the effect estimates."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import day, sales_rows

from stockpulse import schemas
from stockpulse.operators import promotions, search


def panel(spark):
    """Two treated SKUs go from 10 to 18, two controls from 10 to 12, on day 10."""
    parts = [sales_rows(spark, [10] * 10 + [after] * 10, sku).withColumn("revenue_inr", promotions.F.col("sales_qty").cast("decimal(14,2)") * 2)
             for sku, after in (("T1", 18), ("T2", 18), ("C1", 12), ("C2", 12))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_difference_in_differences(spark):
    r = promotions.did_lift(panel(spark), ["T1", "T2"], str(day(10)), str(day(19)), "discount", 20.0).first()
    assert r.did == pytest.approx(6.0) and r.lift_multiplier == pytest.approx(1.5)
    assert r.incremental_revenue_inr == pytest.approx(6 * 20 * 2)
    assert r.price_elasticity == pytest.approx(-2.5)
    assert promotions.did_lift(panel(spark), ["T1"], str(day(10)), str(day(19))).first().price_elasticity is None
    controls = spark.createDataFrame([("C1",)], "sku_id string")
    assert promotions.did_lift(panel(spark), ["T1"], str(day(10)), str(day(19)), controls=controls).first().c_post == 12.0


def test_cannibalization(spark):
    products = spark.createDataFrame([(s, "X") for s in ("T1", "T2", "C1")] + [("C2", "Y")], "sku_id string, category string")
    falling = panel(spark).withColumn("sales_qty", promotions.F.expr("CASE WHEN sku_id = 'C1' THEN 22 - sales_qty ELSE sales_qty END"))
    r = promotions.cannibalization(falling, products, ["T1", "T2"], str(day(10)), str(day(19))).collect()
    assert [(x.category, x.promoted_gain, x.others_change, x.cannibalization_rate) for x in r] == [("X", 160, -20, 0.125)]


def test_expansion_equals_nested_loop(spark, tables):
    sales = [(r.sku_id, r.region, r.date) for r in tables.sales.collect()]
    expected = []
    for p in tables.promotions.collect():
        for s, g, d in sales:
            if p.start_date - dt.timedelta(3) <= d <= p.end_date + dt.timedelta(2) and (
                    p.applicable_skus is None or s in p.applicable_skus) and (p.applicable_regions is None or g in p.applicable_regions):
                expected.append((p.promo_id, s, g, d))
    got = [(r.promo_id, r.sku_id, r.region, r.date) for r in promotions.expand_promotions(tables.sales, tables.promotions, 3, 2).collect()]
    assert sorted(got) == sorted(expected) and len({e[0] for e in expected}) >= 6


def test_repeated_list_entries_and_best_discount(spark):
    sales = sales_rows(spark, [1, 2, 3])
    promos = spark.createDataFrame(
        [("P1", "n", "discount", Decimal("5.00"), day(0), day(1), ["A", "A"], None), ("P2", "n", "bogo", Decimal("9.00"), day(1), day(1), None, ["R", "R"])],
        schemas.PROMOTIONS)
    tagged = [(r.promo_id, r.is_promotion) for r in promotions.tag_promotions(sales, promos).orderBy("date").collect()]
    assert tagged == [("P1", True), ("P2", True), (None, False)]


def test_lift_and_decay(spark):
    sales = sales_rows(spark, [10] * 28 + [25] * 2 + [20, 5])
    promos = spark.createDataFrame([("P", "n", "discount", None, day(28), day(29), None, None)], schemas.PROMOTIONS)
    r = promotions.promo_lift(sales, promos).first()
    assert (r.lift_ratio, r.uplift_pct) == (2.5, 150.0)
    assert [(x.day, x.relative_demand) for x in promotions.promo_decay(sales, promos).orderBy("day").collect()] == [(1, 2.0), (2, 0.5)]


def test_fuzzy_search(spark):
    names = spark.createDataFrame([("1", "Wireless Headphones Pro"), ("2", "Wirless Headphone"), ("3", "Basmati Rice 5kg"), ("4", ""), ("5", "ab")],
                                  "sku_id string, product_name string")
    got = [r.sku_id for r in search.fuzzy_product_search(names, "wireless headphones", 5).collect()]
    assert got[:2] == ["1", "2"] and "4" not in got
    top = search.fuzzy_product_search(names, "Wireless   HEADPHONES-pro", 1).first()
    assert top.similarity == 1.0
    assert search.fuzzy_product_search(names, "ab", 5).first().sku_id == "5"
    assert search.fuzzy_product_search(names, "", 5).count() == 0


def test_similar_names_against_all_pairs(spark):
    import itertools
    import random

    from stockpulse.operators import search

    rng = random.Random(4)
    stock = ["".join(rng.choice("abcde") for _ in range(5)) for _ in range(12)]
    rows = [(f"S{i:03d}", " ".join(rng.sample(stock, rng.randint(1, 4)))) for i in range(120)] + [("S900", None), ("S901", "??")]

    def grams(text):
        return {w[i:i + 3] for w in (f"  {x} " for x in text.split()) for i in range(len(w) - 2)}

    first = {}
    for sku, name in rows[:120]:
        first.setdefault(name, sku)
    for t in (0.4, 0.6, 0.9):
        want = {(a, b): len(grams(x) & grams(y)) / len(grams(x) | grams(y)) for (x, a), (y, b) in itertools.combinations(sorted(first.items(), key=lambda r: r[1]), 2)}
        got = {(r.sku_a, r.sku_b): r.similarity for r in search.similar_names(spark.createDataFrame(rows, "sku_id string, product_name string"), t).collect()}
        assert got == pytest.approx({k: v for k, v in want.items() if v >= t - 1e-9})
