"""Threshold ladders: a measure falls through ordered bounds to a label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from wayfleet.functions.clock import AsOf, today

Steps = Sequence[tuple[float, str]]

# Bounds and labels, tightest first.
OIL_BELOW: Steps = ((20, "CRITICAL"), (50, "LOW"))
FUEL_RATIO_BELOW: Steps = ((0.15, "CRITICAL"), (0.30, "LOW"))
FUEL_PERCENT_BELOW: Steps = ((10, "CRÍTICO"), (20, "BAIXO"))
BATTERY_BELOW: Steps = ((20, "CRITICAL"), (40, "LOW"))
SERVICE_KM_ABOVE: Steps = ((10000, "OVERDUE"), (8000, "DUE_SOON"))
ENGINE_TEMP_ABOVE: Steps = ((100, "OVERHEATING"), (95, "HIGH"))
PRICE_ABOVE: Steps = ((50000, "High"), (25000, "Medium"))
ATTENTION, OPERATIONAL = "ATTENTION_REQUIRED", "OPERATIONAL"


def below(value: Column, steps: Steps, otherwise: str = "OK") -> Column:
    """First label whose bound is strictly above ``value``; NULL takes ``otherwise``."""
    return F.coalesce(*(F.when(value < bound, F.lit(label)) for bound, label in steps), F.lit(otherwise))


def above(value: Column, steps: Steps, otherwise: str = "OK") -> Column:
    """First label whose bound is strictly below ``value``; NULL takes ``otherwise``."""
    return F.coalesce(*(F.when(value > bound, F.lit(label)) for bound, label in steps), F.lit(otherwise))


def attention(*conditions: Column) -> Column:
    """Any true condition asks for attention; unknown conditions are not alarms."""
    calm = F.lit(False)
    return F.when(
        F.greatest(*(F.coalesce(c, F.lit(False)) for c in conditions), calm), F.lit(ATTENTION)
    ).otherwise(F.lit(OPERATIONAL))


def vehicle_age(year: Column, as_of: AsOf = None) -> Column:
    return F.year(today(as_of)) - year


def price_category(price: Column) -> Column:
    return above(price, PRICE_ABOVE, "Low")
