"""Ratios that survive zero denominators (electric cars, parked cars)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _rounded(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def litres_per_100km(fuel: Column, km: Column, digits: int | None = 2) -> Column:
    return _rounded(F.try_divide(fuel, km) * 100, digits)


def average_speed(km: Column, minutes: Column, digits: int | None = 2) -> Column:
    return _rounded(F.try_divide(km, F.try_divide(minutes, F.lit(60))), digits)


def km_per_litre(km: Column, fuel: Column, digits: int | None = 2, empty: float | None = None) -> Column:
    """Distance per unit of fuel; ``empty`` where no fuel was burnt or it is unknown."""
    ratio = _rounded(F.try_divide(km, fuel), digits)
    return F.when(fuel > 0, ratio).otherwise(F.lit(empty).cast("double"))


def fill_ratio(available: Column, capacity: Column) -> Column:
    return F.try_divide(available, capacity)


def fill_level(available: Column, capacity: Column, scale: int = 100, digits: int | None = 2) -> Column:
    """Tank level; ``scale=1, digits=4`` gives the plain ratio used by older tables."""
    return _rounded(fill_ratio(available, capacity) * scale, digits)


def mean_of(columns: list[Column], digits: int | None = 1) -> Column:
    """Row-wise mean, NULL as soon as one input is NULL."""
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return _rounded(total / len(columns), digits)
