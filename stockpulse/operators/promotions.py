"""Promotion effects: campaign expansion, lift, difference in differences, decay, cannibalization."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..schemas import FACT_KEYS
from . import intervals


def promo_windows(promos: DataFrame, days_before: int = 0, days_after: int = 0) -> DataFrame:
    """Campaigns with the first and last day of their widened window."""
    return promos.select(
        "promo_id", "promo_type", F.col("discount_pct").cast("double").alias("discount_pct"), "start_date", "end_date",
        F.date_sub("start_date", days_before).alias("window_start"), F.date_add("end_date", days_after).alias("window_end"),
        "applicable_skus", "applicable_regions")


def expand_promotions(sales: DataFrame, promos: DataFrame, days_before: int = 0, days_after: int = 0) -> DataFrame:
    """Fact rows inside the window of an applicable campaign, one row per (fact row, campaign).

    The membership conditions become three equi-joins: campaigns naming SKUs also join on sku, those naming only
    regions on region, the others on the window alone. The window itself is a few dyadic blocks
    (:mod:`intervals`): a campaign of years is hardly more rows than one of days. Windows that end before they begin
    or lack a bound have no rows.
    """
    windows = promo_windows(promos, days_before, days_after)
    blocks = intervals.with_blocks(windows, "window_start", "window_end")
    by_sku = blocks.filter(F.col("applicable_skus").isNotNull()).withColumn("sku_id", F.explode(F.array_distinct("applicable_skus")))
    no_sku = blocks.filter(F.col("applicable_skus").isNull())
    by_region = no_sku.filter(F.col("applicable_regions").isNotNull()).withColumn(
        "region", F.explode(F.array_distinct("applicable_regions")))
    general = no_sku.filter(F.col("applicable_regions").isNull())
    in_region = F.col("applicable_regions").isNull() | F.array_contains("applicable_regions", F.col("region"))
    # a subquery over the few campaigns bounds the fact, so that the scans open only the months they cover
    span = windows.agg(F.min("window_start").alias("first"), F.max("window_end").alias("last"))
    first, last = (span.select(c).scalar() for c in ("first", "last"))
    fact = sales.filter(F.col("date").between(first, last))
    if fx.MONTH_PARTITION in sales.columns:
        fact = fact.filter(F.col(fx.MONTH_PARTITION).between(F.date_format(first, "yyyy-MM"), F.date_format(last, "yyyy-MM")))
    fact = fact.select(*FACT_KEYS, "sales_qty", "revenue_inr")
    parts = [
        intervals.days_in(fact, by_sku, "sku_id").filter(in_region),
        intervals.days_in(fact, by_region, "region"),
        intervals.days_in(fact, general),
    ]
    day = F.col("date")
    phase = F.when(day < F.col("start_date"), "before").when(day > F.col("end_date"), "after").otherwise("during").alias("phase")
    out = ["promo_id", "promo_type", "discount_pct", "start_date", "end_date", phase, *FACT_KEYS, "sales_qty", "revenue_inr"]
    return reduce(DataFrame.unionByName, [p.select(*out) for p in parts])


def tag_promotions(sales: DataFrame, promos: DataFrame) -> DataFrame:
    """Fact with promo_id and is_promotion; of overlapping campaigns the deepest discount wins."""
    best = expand_promotions(sales, promos).groupBy(*FACT_KEYS).agg(
        F.max_by("promo_id", F.struct("discount_pct", "promo_id")).alias("promo_id"))
    return (sales.drop("promo_id", "is_promotion", fx.MONTH_PARTITION).join(best, FACT_KEYS, "left")
            .withColumn("is_promotion", F.col("promo_id").isNotNull()))


def promo_lift(sales: DataFrame, promos: DataFrame, baseline_days: int = 28) -> DataFrame:
    """Average sales during over the days before, per (sku, campaign)."""
    rows = expand_promotions(sales, promos, days_before=baseline_days)
    qty = F.col("sales_qty")
    means = rows.groupBy("sku_id", "promo_id").agg(
        F.avg(F.when(F.col("phase") == "during", qty)).alias("avg_during"),
        F.avg(F.when(F.col("phase") == "before", qty)).alias("avg_before"))
    return means.withColumns({"lift_ratio": fx.ratio("avg_during", "avg_before"),
                              "uplift_pct": fx.pct(F.col("avg_during") - F.col("avg_before"), "avg_before")})


def promo_decay(sales: DataFrame, promos: DataFrame, days: int = 14, baseline_days: int = 28) -> DataFrame:
    """Demand on each day after a campaign relative to its level before it."""
    rows = expand_promotions(sales, promos, days_before=baseline_days, days_after=days)
    after = F.when(F.col("phase") == "after", F.datediff("date", "end_date"))
    base = rows.filter(F.col("phase") == "before").groupBy("promo_id").agg(F.avg("sales_qty").alias("baseline"))
    daily = rows.filter(F.col("phase") == "after").groupBy("promo_id", after.alias("day")).agg(F.avg("sales_qty").alias("avg_sales"))
    return daily.join(base, "promo_id").withColumn("relative_demand", fx.ratio("avg_sales", "baseline"))


def _windowed(sales: DataFrame, start, end) -> DataFrame:
    """Rows of the campaign and of the equally long window before it."""
    begin, stop = fx.as_day(start), fx.as_day(end)
    rows = fx.trailing(sales, begin, (stop - begin).days + 1)
    return rows.filter(F.col("date") <= F.lit(stop)).withColumn("post", F.col("date") >= F.lit(begin))


def did_lift(sales: DataFrame, sku_ids, start, end, promo_type: str = "discount", discount_pct: float | None = None,
             regions=None, controls: DataFrame | None = None) -> DataFrame:
    """Difference in differences of average daily sales, as one row.

    Treated rows are the named SKUs. Controls are all other SKUs, or only the ``sku_id`` rows of
    ``controls``. With ``regions`` both are looked at in these regions only: a promoted SKU elsewhere is
    neither. ``price_elasticity`` is null without a discount.
    """
    rows = _windowed(sales, start, end).withColumn("treated", F.col("sku_id").isin(*sku_ids))
    if regions:
        rows = rows.filter(F.col("region").isin(*regions))
    if controls is not None:
        allowed = controls.select("sku_id").distinct().withColumn("_control", F.lit(True))
        rows = rows.join(allowed, "sku_id", "left").filter(F.col("treated") | F.col("_control"))
    qty, rev = F.col("sales_qty"), F.col("revenue_inr").cast("double")

    def mean(is_treated: bool, post: bool, value=qty):
        cell = (F.col("treated") == is_treated) & (F.col("post") == post)
        return F.avg(F.when(cell, value))

    during = F.col("treated") & F.col("post")
    stats = rows.agg(
        mean(True, False).alias("t_pre"), mean(True, True).alias("t_post"),
        mean(False, False).alias("c_pre"), mean(False, True).alias("c_post"),
        F.count_if(during).alias("treated_rows"),
        fx.ratio(F.sum(F.when(during, rev)), F.sum(F.when(during, qty))).alias("unit_revenue"))
    effect = (F.col("t_post") - F.col("t_pre")) - (F.col("c_post") - F.col("c_pre"))
    expected = F.col("t_pre") + F.col("c_post") - F.col("c_pre")
    discount = F.lit(discount_pct).cast("double")
    return stats.select(
        F.lit(promo_type).alias("promotion_type"), "t_pre", "t_post", "c_pre", "c_post", "treated_rows",
        effect.alias("did"), fx.ratio("t_post", expected).alias("lift_multiplier"),
        (effect * F.col("treated_rows") * F.col("unit_revenue")).alias("incremental_revenue_inr"),
        (fx.pct(effect, expected) / F.nullif(-discount, F.lit(0.0))).alias("price_elasticity"))


def cannibalization(sales: DataFrame, products: DataFrame, sku_ids, start, end) -> DataFrame:
    """Per category of the promoted SKUs: units lost by the others over units gained by the promoted."""
    rows = _windowed(sales, start, end).join(products.select("sku_id", "category"), "sku_id").withColumn(
        "treated", F.col("sku_id").isin(*sku_ids))
    sign = F.when(F.col("post"), F.col("sales_qty")).otherwise(-F.col("sales_qty"))
    change = rows.groupBy("category").agg(
        F.coalesce(F.sum(F.when(F.col("treated"), sign)), F.lit(0)).alias("promoted_gain"),
        F.coalesce(F.sum(F.when(~F.col("treated"), sign)), F.lit(0)).alias("others_change"),
        F.count_if("treated").alias("promoted_rows")).filter("promoted_rows > 0")
    lost = F.greatest(F.lit(0), -F.col("others_change"))
    return change.select("category", "promoted_gain", "others_change",
                         F.when(F.col("promoted_gain") > 0, fx.ratio(lost, "promoted_gain")).alias("cannibalization_rate"))
