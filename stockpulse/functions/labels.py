"""Anomaly direction, cause and score; cluster labels; report flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import _c, lookup

#: Strategy text per cluster label.
CLUSTER_STRATEGIES = {
    "Stars": "Premium placement · high service level · tighter safety stock",
    "Cash Cows": "Long tail management · lower reorder frequency · premium pricing",
    "Volume Movers": "Bulk ordering · warehouse efficiency · thin margin protection",
    "Tail SKUs": "Review for clearance · discontinue if margin negative",
}


#: Strict bounds of the stock drop (percent), price difference (percent) and weather score.
DROP_LIMIT, PRICE_LIMIT, WEATHER_LIMIT = 30, 15, -0.5


def direction(actual, expected) -> Column:
    return F.when(_c(actual) > _c(expected), "spike").otherwise("drop")


def probable_cause(promo="is_promotion", moved="direction", holiday="is_holiday", drop_pct="inventory_drop_pct",
                   price_delta="competitor_price_delta", weather="weather_score") -> Column:
    """First matching rule wins; bounds are strict, missing measurements count as 0."""
    def known(c) -> Column:
        return F.coalesce(_c(c), F.lit(0.0))

    return (F.when(_c(promo) & (_c(moved) == "spike"), "Promotion spike")
            .when(_c(holiday), "Festive demand surge")
            .when(known(drop_pct) > DROP_LIMIT, "Supply disruption")
            .when(F.abs(known(price_delta)) > PRICE_LIMIT, "Competitor price event")
            .when((_c(moved) == "drop") & (known(weather) < WEATHER_LIMIT), "Adverse weather impact")
            .otherwise("Unexplained anomaly"))


def minmax_score(raw, low, high) -> Column:
    """1 = most anomalous; ``raw`` is higher for more normal rows."""
    scaled = F.lit(1.0) - (_c(raw) - _c(low)) / (_c(high) - _c(low) + F.lit(1e-9))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled))


def cluster_label(velocity, median_velocity, margin, median_margin) -> Column:
    fast, rich = _c(velocity) >= _c(median_velocity), _c(margin) >= _c(median_margin)
    return (F.when(fast & rich, "Stars").when(rich, "Cash Cows").when(fast, "Volume Movers").otherwise("Tail SKUs"))


def strategy(label) -> Column:
    return lookup(label, CLUSTER_STRATEGIES, "Review manually")


def lift_band(lift) -> Column:
    return F.when(_c(lift) > 3, "high").when(_c(lift) > 2, "medium").otherwise("low")


def below_reorder(stock, rop) -> Column:
    return _c(stock) < _c(rop)


def low_supply(supply_days) -> Column:
    return _c(supply_days) < 10


def good_accuracy(accuracy_pct) -> Column:
    return _c(accuracy_pct) > 90


def many_stockouts(stockouts) -> Column:
    return _c(stockouts) > 30
