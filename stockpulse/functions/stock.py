"""Inventory formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import _c

#: Normal quantile per service level.
SERVICE_LEVEL_Z = {0.90: 1.28, 0.95: 1.65, 0.99: 2.33}
DEFAULT_Z = 1.65
HOLDING_PCT = 0.25
ORDERING_COST_INR = 500.0


def z_value(service_level: float) -> float:
    return SERVICE_LEVEL_Z.get(service_level, DEFAULT_Z)


def eoq(annual_demand, unit_cost, ordering_cost=ORDERING_COST_INR, holding_pct=HOLDING_PCT) -> Column:
    """Economic order quantity, at least one unit; a month of demand without usable costs."""
    demand = _c(annual_demand).cast("double")
    holding = _c(unit_cost).cast("double") * F.lit(holding_pct)
    order_cost = F.lit(float(ordering_cost)) if not isinstance(ordering_cost, Column) else ordering_cost
    usable = (holding > 0) & (order_cost > 0)
    wilson = F.bround(F.sqrt(F.lit(2.0) * demand * order_cost / F.nullif(holding, F.lit(0.0))))
    return F.greatest(
        F.lit(1).cast("long"),
        F.when(usable, wilson.cast("long")).otherwise((demand / 12).cast("long")),
    )


def safety_stock(demand_std, lead_time, service_level: float = 0.95) -> Column:
    need = F.lit(z_value(service_level)) * _c(demand_std).cast("double") * F.sqrt(_c(lead_time).cast("double"))
    return F.greatest(F.lit(0).cast("long"), F.ceil(need).cast("long"))


def reorder_point(avg_demand, lead_time, safety) -> Column:
    level = _c(avg_demand).cast("double") * _c(lead_time) + _c(safety)
    return F.greatest(F.lit(0).cast("long"), F.ceil(level).cast("long"))


def days_of_supply(stock, avg_demand) -> Column:
    avg = _c(avg_demand).cast("double")
    return F.when(avg > 0, F.round(_c(stock).cast("double") / F.nullif(avg, F.lit(0.0)), 1)).otherwise(F.lit(999.0))


def stockout_risk(supply_days, lead_time) -> Column:
    lead = _c(lead_time)
    decay = F.exp(-_c(supply_days) / F.greatest(lead.cast("double"), F.lit(1.0)))
    return F.when(lead <= 0, F.lit(0.0)).otherwise(
        F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), decay)), 4))


def priority(supply_days) -> Column:
    dos = _c(supply_days)
    return F.when(dos < 5, "critical").when(dos < 14, "warning").otherwise("healthy")


def priority_rank(label) -> Column:
    label = _c(label)
    return F.when(label == "critical", 0).when(label == "warning", 1).otherwise(2)


def recommended_order(eoq_qty, rop, stock, safety) -> Column:
    q, r, s, ss = _c(eoq_qty), _c(rop), _c(stock), _c(safety)
    return F.when(s < r, F.greatest(q, r - s + ss)).otherwise(q)


def estimated_cost(eoq_qty, unit_cost) -> Column:
    return F.round(_c(eoq_qty) * _c(unit_cost).cast("double"), 2)
