"""Business rules as column expressions: ratios, flags, labels and risk tiers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of returns that is high, and label thresholds on the degradation factor.
HIGH_RETURN_SHARE = 0.10
DEGRADING_ABOVE = 0.3
FAILING_ABOVE = 0.8

# Lower bound of each tier, highest first, with the advice shown for it.
RISK_TIERS = [
    ("CRITICAL", 0.75, "Immediate shutdown and inspection required!"),
    ("HIGH", 0.50, "Schedule maintenance within 2 hours."),
    ("MEDIUM", 0.25, "Monitor closely and plan maintenance soon."),
    ("LOW", None, "Machine operating normally."),
]


def is_true(condition: Column) -> Column:
    """A condition as a flag that is never NULL: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def relative_change(value: Column, base: Column) -> Column:
    """(value - base) / base; 0.0 where the base is NULL or zero, NULL where only the value is."""
    return F.when(base.isNotNull() & (base != 0), (value - base) / base).otherwise(F.lit(0.0))


def high_return(returns: Column, quantity: Column) -> Column:
    return is_true(returns > quantity * HIGH_RETURN_SHARE)


def net_revenue(quantity: Column, returns: Column, unit_price: Column) -> Column:
    """Revenue after returns in exact cents."""
    return F.round((quantity - returns) * unit_price.cast("decimal(18,4)"), 2)


def revenue_mismatch(
    revenue: Column, quantity: Column, returns: Column, unit_price: Column, tolerance: float = 0.01
) -> Column:
    """True where the stated revenue is further than ``tolerance`` from the computed one."""
    gap = F.abs(revenue.cast("decimal(18,2)") - net_revenue(quantity, returns, unit_price))
    return is_true(gap > F.lit(tolerance).cast("decimal(18,6)"))


def above_limit_flags(limits: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """``{flag: (sensor, limit)}`` to one flag per pair; a missing limit gives false."""
    return {flag: is_true(F.col(sensor) > F.col(limit)) for flag, (sensor, limit) in limits.items()}


def outside_range_flag(ranges: Mapping[str, tuple[str, str]]) -> Column:
    """True where any ``{sensor: (low, high)}`` lies outside its normal range."""
    return any_of(
        is_true((F.col(sensor) < F.col(low)) | (F.col(sensor) > F.col(high)))
        for sensor, (low, high) in ranges.items()
    )


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def is_degrading(factor: Column) -> Column:
    return factor > DEGRADING_ABOVE


def is_failing(factor: Column) -> Column:
    return factor > FAILING_ABOVE


def machine_age_years(on: Column, installed: Column) -> Column:
    """Age at the given date in years of 365 days, one digit."""
    return F.round(F.datediff(on, installed) / 365, 1)


def failure_probability(probability: Column) -> Column:
    return F.round(probability, 4)


def risk_level(probability: Column) -> Column:
    """Tier of a probability; a NULL probability has no tier."""
    (name, floor, _), *others = RISK_TIERS
    level = F.when(probability >= floor, name)
    for name, floor, _ in others:
        level = level.when(probability.isNotNull() if floor is None else probability >= floor, name)
    return level


def recommendation(level: Column) -> Column:
    pairs = [F.lit(part) for name, _, advice in RISK_TIERS for part in (name, advice)]
    return F.create_map(*pairs)[level]
